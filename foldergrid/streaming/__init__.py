"""Incremental ingest and interval flushes."""
