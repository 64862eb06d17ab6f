"""Catalog of raw sources and result tables, file readers and sinks."""
