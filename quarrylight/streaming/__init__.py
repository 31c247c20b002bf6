"""Structured Streaming forms of the reuse operators."""
