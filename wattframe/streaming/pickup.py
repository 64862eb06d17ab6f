"""Incremental pick-up of newly landed raw files into a cleaned table.

Each run reads only files it has not seen, cleans them and appends the rows that the table does
not hold yet. A stored row carries a digest of itself; batches are compared by the digests of their
years alone, so the stored rows' own columns are neither read nor shuffled. A micro-batch owns the folder ``batch_id=<query>-<n>``, where the query's id lives in
its checkpoint: a repeated batch (lost executors, a restarted driver) replaces that folder only,
and rows of other batches are never rewritten or deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattframe.operators.rows import DELIVERED_AT, DELIVERED_FROM, delivery
from wattframe.sources.files import text_schema

BATCH, BUCKET = "batch_id", "period_year"
#: The folder of what has no year, as Spark names it and as a part of a stored table.
_HIVE_NULL, NO_YEAR = "__HIVE_DEFAULT_PARTITION__", "none"
PICKED_AT = "picked_at"
#: 128 bits of a row's columns. Rows with equal digests count as equal.
DIGEST = "row_digest"
QUERY_ID = "sql.streaming.queryId"


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its folder columns, or None before the first batch."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise
    return table.withColumns({BATCH: F.col(BATCH).cast("string"), BUCKET: F.col(BUCKET).cast("int")})


def read_picked_up(spark: SparkSession, path: str, picked_at: bool = False) -> DataFrame:
    """The cleaned rows; with ``picked_at`` also when and from which file each came."""
    hidden = [BATCH, BUCKET, DIGEST]
    if not picked_at:
        hidden += [PICKED_AT, DELIVERED_AT, DELIVERED_FROM]
    return spark.read.parquet(path).drop(*hidden)


def batch_parts(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The batches that have landed, each with its years' folders; nothing but folders is listed."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def below(folder, column: str) -> dict:
        found = files.listStatus(folder) if files.exists(folder) else []
        named = ((status.getPath(), status.getPath().getName()) for status in found)
        return {name.removeprefix(f"{column}="): at for at, name in named if name.startswith(f"{column}=")}

    return {
        batch: [NO_YEAR if year == _HIVE_NULL else year for year in below(at, BUCKET)]
        for batch, at in below(root, BATCH).items()
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS"))
    }


def read_batches(spark: SparkSession, path: str, batches: list[str]) -> DataFrame:
    """The cleaned rows of some batches; others are not opened."""
    hidden = [BUCKET, DIGEST, PICKED_AT, DELIVERED_AT, DELIVERED_FROM]
    frames = [spark.read.parquet(f"{path.rstrip('/')}/{BATCH}={batch}").drop(*hidden) for batch in batches]
    return reduce(lambda a, b: a.unionByName(b), frames)


def newest_delivery(rows: DataFrame) -> list[Column]:
    """Order of revisions, the last one first: by the time of the delivered file, then its path.

    Both hold within one batch too, where all rows are picked up at the same time.
    """
    return [F.desc(name) for name in [*delivery(rows), PICKED_AT]]


def year_of(rows: DataFrame) -> Column:
    """The folder of a row. What is no calendar year shares one folder, so folders stay few."""
    year = F.year("period") if "period" in rows.columns else F.col("year")
    return F.when(year.between(1, 9999), year)


def row_digest(rows: DataFrame) -> Column:
    """128 bits that equal rows share: names, NULLs and empty texts count, and both zeros are one."""
    columns = [
        (F.col(f"`{field.name}`") + 0.0 if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{field.name}`"))
        .alias(field.name)
        for field in sorted(rows.schema.fields, key=lambda field: field.name)
    ]
    return F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")))


def append_new_rows(
    rows: DataFrame, path: str, batch: str, every_delivery: bool = False
) -> None:
    """Append the distinct rows that other batches did not bring.

    Of the stored rows, the digests of this batch's years are read. ``every_delivery`` appends rows
    that are known as well: where the latest revision of a key counts, a value that returns to what it
    was before must not be lost.
    """
    spark = rows.sparkSession
    fresh = rows.withColumns({DIGEST: row_digest(rows), BUCKET: year_of(rows)}).persist()
    stored = None if every_delivery else stored_rows(spark, path)
    new = fresh
    if stored is not None:
        # Calendar years: a handful per batch.
        years = [row[0] for row in fresh.select(BUCKET).distinct().toLocalIterator()]
        same_years = F.col(BUCKET).isin([year for year in years if year is not None])
        if None in years:
            same_years = same_years | F.col(BUCKET).isNull()
        stored = stored.where((F.col(BATCH) != batch) & same_years)
        # Batches from before rows had digests: theirs are worked out, which reads all columns.
        if DIGEST not in stored.columns:
            stored = stored.withColumn(DIGEST, row_digest(rows))
        elif not stored.where(F.col(DIGEST).isNull()).isEmpty():
            stored = stored.withColumn(DIGEST, F.coalesce(DIGEST, row_digest(rows)))
        others = stored.select(DIGEST)
        new = new.join(others, DIGEST, "left_anti")
    # The distinct step finds equal rows together where the join has dealt them by digest.
    (
        new.dropDuplicates()
        .withColumn(PICKED_AT, F.current_timestamp())
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(f"{path.rstrip('/')}/{BATCH}={batch}")
    )
    fresh.unpersist()


def pick_up(
    spark: SparkSession,
    landing: str,
    columns: list[str],
    clean: Callable[[DataFrame], DataFrame],
    table_path: str,
    checkpoint_path: str,
    max_files: int | None = None,
    every_delivery: bool = False,
    one_per_line: bool = False,
) -> StreamingQuery:
    """Start a run over all files landed since the last one; it ends by itself.

    ``columns`` is the header of the landed files; Spark raises when a file has another one. By
    default the table holds distinct rows. With ``every_delivery`` it holds each delivery of a
    row with the time and path of its file, from which ``latest_revision`` by
    :func:`newest_delivery` takes the last one per key; ``clean`` must keep both columns, as all
    cleaning steps do (:func:`wattframe.operators.rows.delivery`).

    A record may span lines unless ``one_per_line`` says that none does; only then a file is split.
    """
    reader = (
        spark.readStream.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", not one_per_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def append(raw: DataFrame, number: int) -> None:
        query = raw.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        cleaned = clean(raw)
        if every_delivery and not delivery(cleaned):
            raise ValueError(f"the cleaning step must keep {DELIVERED_AT} and {DELIVERED_FROM}")
        append_new_rows(cleaned, table_path, f"{query}-{number}", every_delivery)

    landed = reader.csv(landing)
    if every_delivery:
        landed = landed.select(
            "*",
            F.col("_metadata.file_modification_time").alias(DELIVERED_AT),
            F.col("_metadata.file_path").alias(DELIVERED_FROM),
        )
    return (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
