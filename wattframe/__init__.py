"""Spark-native engine for published energy statistics.

Packages
--------
``functions``  Column-only building blocks (parsing, labels, percentages, calendar)
``sources``    catalog of raw sources and result tables, file readers and sinks
``operators``  DataFrame -> DataFrame operators (shares, pivots, changes, ranking, dedup)
``plans``      cleaning steps, result tables, ingest ranges, read-side queries, full refresh
``streaming``  incremental pick-up of newly landed files
"""
