"""Versioned changes, checks and history for large tables, as Spark jobs."""
