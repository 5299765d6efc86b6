"""Incremental forms of the batch steps."""
