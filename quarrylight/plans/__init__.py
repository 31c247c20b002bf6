"""Multi-operator jobs."""
