"""Composed plans: the full build, test-table adapters and the query registry."""
