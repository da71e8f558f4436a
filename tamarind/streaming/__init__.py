"""Incremental state as Structured Streaming."""
