"""Structured Streaming paths for ingest and latest-wins upsert."""
