"""Incremental ingest of landed files with Structured Streaming."""
