"""Structured Streaming forms of the hourly rollup and of the upsert."""
