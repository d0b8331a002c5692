"""Queries over the test tables: inputs as landed payloads, and their SQL twins."""
