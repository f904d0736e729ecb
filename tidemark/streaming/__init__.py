"""Structured Streaming: incremental ingest and keyed upserts."""
