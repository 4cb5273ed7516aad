"""Structured Streaming jobs (STR-1)."""
