"""Incremental ingestion as a Structured Streaming sink."""
