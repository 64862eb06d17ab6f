"""Cleaning steps, result tables, ingest ranges, read-side queries and the full refresh."""
