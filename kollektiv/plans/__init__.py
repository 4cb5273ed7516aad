"""Composite plans: the staging, silver and gold models and the ingest jobs."""
