"""Scans of landed payloads and the tables the jobs keep."""
