"""Incremental ingest of new drops."""
