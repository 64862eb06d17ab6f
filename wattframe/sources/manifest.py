"""What is known about landed raw files, so that no file's text is read twice to find it out.

A manifest is a small stored table with one row per file: path, length and time of modification, the
header, whether a record spans lines, and the first and last period of its rows. It is brought up to
date by reading the text of new or changed files only. A reader takes the layouts from it, without a pass over
the text, and leaves out files whose periods lie outside the range that is asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.session import keep
from wattframe.sources import snapshots
from wattframe.sources.files import (
    INCREMENTAL_FOLDER,
    csv_frame,
    file_layouts,
    layouts_of,
    list_files,
    newest_extract,
    plain_path,
)

#: What tells a file from a later one with the same path.
IDENTITY = ["path", "length", "modificationTime"]
COLUMNS = (
    "path string, length long, modificationTime timestamp, header string, spans boolean, "
    "first_period string, last_period string, records long"
)


def read_manifest(spark: SparkSession, stored: str) -> DataFrame:
    """The manifest as it is stored; no rows before the first update."""
    snapshot = snapshots.current(spark, stored)
    return spark.createDataFrame([], COLUMNS) if snapshot is None else snapshots.read(spark, stored, snapshot)


def update_manifest(spark: SparkSession, root: str, stored: str, key: str = "period") -> list[str]:
    """Bring the manifest of the CSV files below ``root`` up to date; returns the files that were read.

    Incremental extracts are in it too. Files that are gone leave it; a file with another length or time is
    a new one. What is collected are the paths of new files. Without any change nothing is written. A file
    without text has no header, and no reader opens it.
    """
    known = read_manifest(spark, stored)
    listed = keep(list_files(spark, root, include_incremental=True).select(*IDENTITY))
    fresh = keep(listed.join(known.select(*IDENTITY), IDENTITY, "left_anti"))
    kept = known.join(listed, IDENTITY, "left_semi")
    paths = [row["path"] for row in fresh.select("path").toLocalIterator()]
    if not paths:
        if kept.count() != known.count():
            snapshots.replace(keep(kept), stored)
        return []
    layouts = keep(file_layouts(spark, paths, key))  # the text's own pass
    dated = F.when(F.col(key).rlike(r"^\s*\d{4}"), F.trim(key))
    rows = [
        csv_frame(spark, header, spans, of)
        .groupBy(plain_path().alias("path"))
        .agg(F.min(dated).alias("first_period"), F.max(dated).alias("last_period"), F.count("*").alias("records"))
        for (header, spans), of in layouts_of(layouts).items()
    ]
    described = fresh.join(layouts, "path", "left")
    if rows:
        described = described.join(reduce(DataFrame.unionByName, rows), "path", "left")
    else:
        none = F.lit(None).cast("string")
        described = described.withColumns({"first_period": none, "last_period": none, "records": F.lit(0).cast("long")})
    described = described.select(*known.columns)
    snapshots.replace(keep(kept.unionByName(described)), stored)
    return paths


def in_periods(start: str | None, end: str | None) -> Column:
    """Files that can hold a period from ``start`` to ``end``, both included, in the period's own text.

    A coarser bound takes in all of its year or month. A file without a readable period is taken.
    """
    condition = F.lit(True)
    if start:
        condition &= F.substring("last_period", 1, len(start)) >= start
    if end:
        condition &= F.substring("first_period", 1, len(end)) <= end
    return F.coalesce(condition, F.lit(True))


def read_known(
    spark: SparkSession,
    stored: str,
    start: str | None = None,
    end: str | None = None,
    include_incremental: bool | None = None,
    newest_only: bool = False,
) -> DataFrame:
    """The raw rows of the files in a manifest, as :func:`wattframe.sources.files.read_csv` gives them.

    Only files that can hold a period of the range are opened; their rows are not filtered. One path
    per opened file goes to the driver, as Spark's reader needs it.
    """
    if include_incremental is None:
        include_incremental = newest_only
    files = read_manifest(spark, stored)
    if not include_incremental:
        files = files.where(~F.col("path").contains(INCREMENTAL_FOLDER))
    if newest_only:
        files = newest_extract(files)
    layouts = layouts_of(files.where(in_periods(start, end)).select("path", "header", "spans"))
    if not layouts:
        raise FileNotFoundError(f"no file in {stored} has a period from {start} to {end}")
    frames = [csv_frame(spark, header, spans, paths) for (header, spans), paths in layouts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_known_period(spark: SparkSession, stored: str) -> str | None:
    """The largest period of all landed files, without opening one."""
    return read_manifest(spark, stored).agg(F.max("last_period")).first()[0]
