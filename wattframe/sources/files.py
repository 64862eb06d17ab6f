"""Readers and sinks: raw CSV, landed JSON pages, Parquet tables."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.sources import snapshots
from wattframe.sources.catalog import SourceSpec
from wattframe.sources.sorting import in_order

INCREMENTAL_FOLDER = "/incremental/"
LOADED_AT = "loaded_at"


def text_schema(columns) -> T.StructType:
    """Every raw column is text; the cleaning step types it."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def list_files(
    spark: SparkSession,
    root: str | list[str],
    pattern: str = "*.csv",
    include_incremental: bool = False,
) -> DataFrame:
    """Files below ``root`` as ``path, length, modificationTime``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    if include_incremental:
        return files
    return files.where(~F.col("path").contains(INCREMENTAL_FOLDER))


def newest_extract(files: DataFrame) -> DataFrame:
    """The files of the extract modified last; the path decides between equal times.

    An extract is one file, or a folder of part files when Spark wrote it.
    """
    extracts = files.withColumn("extract", F.regexp_replace("path", "/part-[^/]*$", ""))
    newest = (
        extracts.groupBy("extract")
        .agg(F.max("modificationTime").alias("modified"))
        .orderBy(F.desc("modified"), F.desc("extract"))
        .first()
    )
    if newest is None:
        return files
    return extracts.where(F.col("extract") == newest["extract"]).drop("extract")


def plain_path() -> Column:
    """The path of a row's file as a listing has it; the metadata column has it URL-encoded."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def file_layouts(spark: SparkSession, paths: list[str], key: str = "period") -> DataFrame:
    """``path, header, spans`` of each file with text: its header line, and whether any record spans lines.

    One distributed pass over the text: only lines that can be a header (they hold the column
    ``key``) and lines that leave a quoted field open leave the scan, so what is grouped per file is
    tiny. A file without such lines can be split and read in parallel with the same result
    as a whole-file parse; only the others need the latter.
    """
    # What is left to open a quoted field once all that are closed on their line are gone. A quote
    # inside an unquoted field, such as an inch mark, opens nothing.
    closed = F.regexp_replace("value", r'(^|,)"(?:[^"]|"")*"(?=,|$)', "$1")
    lines = spark.read.text(paths).select(
        plain_path().alias("path"),
        F.struct(
            F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        ).alias("position"),
        F.col("value").alias("line"),
        closed.rlike(r'(^|,)"').alias("spans"),
    )
    return (
        lines.where(F.col("spans") | F.col("line").contains(key))
        .groupBy("path")
        .agg(
            F.min_by("line", F.when(F.col("line").contains(key), F.col("position"))).alias("header"),
            F.max("spans").alias("spans"),
        )
    )


def layouts_of(files: DataFrame, key: str = "period") -> dict[tuple[tuple[str, ...], bool], list[str]]:
    """Paths by header and by whether records span lines, from ``path, header, spans``; files without
    text are left out. One row per file goes to the driver, as many as the listing itself has."""
    layouts: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for row in files.where("spans IS NOT NULL").orderBy("path").toLocalIterator():
        header = tuple(next(csv.reader([row["header"] or ""]), ()))
        if key not in header:
            raise ValueError(f"no header with a column {key!r} in {row['path']}")
        layouts.setdefault((header, row["spans"]), []).append(row["path"])
    return {layout: layouts[layout] for layout in sorted(layouts)}


def csv_layouts(spark: SparkSession, paths: list[str], key: str = "period") -> dict:
    """:func:`file_layouts` grouped as :func:`layouts_of` does."""
    return layouts_of(file_layouts(spark, paths, key), key)


def csv_frame(spark: SparkSession, header: tuple[str, ...], spans_lines: bool, paths: list[str]) -> DataFrame:
    """Files of one layout as text columns; Spark raises if a file has another header."""
    return (
        spark.read.schema(text_schema(header))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", spans_lines)
        .csv(paths)
    )


def read_csv(
    spark: SparkSession,
    root: str | list[str],
    columns: list[str] | None = None,
    *,
    include_incremental: bool | None = None,
    newest_only: bool = False,
    loaded_at: bool = False,
    key: str = "period",
    one_per_line: bool = False,
) -> DataFrame:
    """All raw CSV files below ``root`` as one frame of text columns, matched by name.

    Without ``columns`` the files may differ in column order and in columns (see
    :func:`csv_layouts`); a column that a file lacks is NULL there. With ``columns`` all files are
    taken to have exactly that header: no extra pass and no list of paths, and Spark raises if a
    header differs. Records may span lines, so a file is parsed as a whole, unless ``one_per_line``
    says that none does. ``newest_only`` reads the newest extract alone, an incremental one
    too; otherwise incremental folders are skipped, unless ``include_incremental`` says different.
    ``loaded_at`` adds the file's modification time, which orders revisions of the same key.
    """
    if include_incremental is None:
        include_incremental = newest_only
    if columns and not newest_only:
        return _read_declared(
            spark, root, columns, include_incremental, loaded_at, one_per_line
        )
    files = list_files(spark, root, include_incremental=include_incremental)
    if newest_only:
        files = newest_extract(files)
    paths = [row["path"] for row in files.select("path").collect()]  # one job, however many files
    if not paths:
        raise FileNotFoundError(f"no CSV files below {root}")
    whole = not one_per_line
    layouts = {(tuple(columns), whole): paths} if columns else csv_layouts(spark, paths, key)
    if not layouts:
        raise FileNotFoundError(f"only empty CSV files below {root}")

    def read_layout(layout, layout_paths):
        frame = csv_frame(spark, *layout, layout_paths)
        if loaded_at:
            frame = frame.select("*", F.col("_metadata.file_modification_time").alias(LOADED_AT))
        return frame

    frames = [read_layout(layout, layouts[layout]) for layout in sorted(layouts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _read_declared(
    spark: SparkSession,
    root: str | list[str],
    columns: list[str],
    include_incremental: bool,
    loaded_at: bool,
    one_per_line: bool,
) -> DataFrame:
    """All CSV files below ``root`` in one scan: Spark lists the folder, the driver holds no paths."""
    frame = (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", not one_per_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(root)
    )
    if not include_incremental:
        frame = frame.where(~F.col("_metadata.file_path").contains(INCREMENTAL_FOLDER))
    if loaded_at:
        frame = frame.select("*", F.col("_metadata.file_modification_time").alias(LOADED_AT))
    return frame


def read_pages(
    spark: SparkSession,
    root: str | list[str],
    columns: list[str] | None = None,
    one_per_line: bool = False,
) -> DataFrame:
    """Records of landed JSON pages ``{"response": {"total", "data": [...]}}`` as text columns.

    Without ``columns`` the first record of the first page (by path) fixes them. Other fields are
    ignored and absent ones are NULL. A page holds at most one page size of records; a file is one
    page, or with ``one_per_line`` many, which Spark can then split.
    """
    page = T.StructType(
        [
            T.StructField(
                "response",
                T.StructType(
                    [
                        T.StructField("total", T.StringType()),
                        T.StructField(
                            "data", T.ArrayType(T.MapType(T.StringType(), T.StringType()))
                        ),
                    ]
                ),
            )
        ]
    )
    pages = (
        spark.read.schema(page)
        .option("multiLine", not one_per_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(root)
    )
    if columns is None:
        first = (
            pages.where(F.size("response.data") > 0)
            .select(
                F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("place"),
                F.map_keys(F.col("response.data")[0]).alias("names"),
            )
            .orderBy("path", "block", "place")
            .first()
        )
        if first is None:
            raise FileNotFoundError(f"no records in the pages below {root}")
        columns = first["names"]
    return explode_records(pages, F.col("response.data"), columns)


def explode_records(pages: DataFrame, records: Column, columns: list[str]) -> DataFrame:
    """One row per record of an array of maps, with the given fields as columns."""
    return pages.select(F.explode(records).alias("record")).select(
        *[F.col("record")[name].alias(name) for name in columns]
    )


def raw_folder(
    base: str,
    source: SourceSpec,
    start: str | None,
    end: str | None,
    run_day: str | None = None,
    incremental: bool = False,
) -> str:
    """Where a raw extract goes: the range is in the name; incremental ones have their own folder
    and the day of the run (``yyyyMMdd``) in the name."""
    name = f"{source.name}_{start or 'all'}_to_{end or 'all'}"
    if incremental:
        return f"{base.rstrip('/')}/{source.raw_prefix}{INCREMENTAL_FOLDER}{name}_{run_day}"
    return f"{base.rstrip('/')}/{source.raw_prefix}/{name}"


def write_csv(records: DataFrame, folder: str) -> None:
    """Raw records as CSV files with a header. Re-running a load replaces its own folder only."""
    (
        records.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; of one with snapshots, the newest as it is now (see :mod:`.snapshots`)."""
    snapshot = snapshots.current(spark, path)
    return spark.read.parquet(path) if snapshot is None else snapshots.read(spark, path, snapshot)


def write_table(
    table: DataFrame, path: str, sort=(), partition_by: list[str] | None = None
) -> None:
    """Replace a Parquet table. While it is written, readers find it incomplete;
    :func:`wattframe.sources.snapshots.replace` is the way for tables that are read meanwhile.

    Sorting happens in the sinks and only there (:func:`wattframe.sources.sorting.in_order`).
    ``partition_by`` adds folders for very long histories.
    """
    if sort:
        table = in_order(table, sort)
    writer = table.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
