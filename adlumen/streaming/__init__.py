"""Continuous forms of ingest, deduplication and windowed counts."""
