"""Incremental forms of ingest, first photo and running metrics on Structured Streaming."""
