"""Semantic search, fuzzy clustering and query reuse as Spark jobs."""
