"""Structured Streaming jobs: ingestion, keep-last upsert, change detection."""
