"""Incremental ingest of landed activity pages."""
