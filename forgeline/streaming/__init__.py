"""Structured Streaming entry points (incremental Bronze ingestion)."""
