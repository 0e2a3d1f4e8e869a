"""Incremental ingest as a Structured Streaming job."""
