"""Incremental ingest of landed documents."""
