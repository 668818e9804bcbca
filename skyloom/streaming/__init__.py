"""Structured Streaming jobs: ingest, keyed upsert, daily refresh, scoring."""
