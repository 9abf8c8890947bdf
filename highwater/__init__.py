"""Incremental refresh on Spark: what changed, what must be loaded again, and why."""
