"""Readers, table layouts and writers."""
