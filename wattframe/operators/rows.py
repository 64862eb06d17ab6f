"""Row selection: presence tests, exact duplicates, revisions, numeric columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: When a delivered row's file was last modified, and which file it was: newer files are revisions.
DELIVERED_AT, DELIVERED_FROM = "delivered_at", "delivered_from"


def delivery(rows: DataFrame) -> list[str]:
    """The columns that say when and with which file a row was delivered, if it has them."""
    return [name for name in (DELIVERED_AT, DELIVERED_FROM) if name in rows.columns]


def any_present(*names: str) -> Column:
    """At least one of the columns has a value."""
    return reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in names])


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Whole-row dedup. A changed value for the same key is another row and stays.

    Raw rows that differ only in columns dropped before this call become one row; that is the
    published behaviour of the cleaned tables.
    """
    return rows.dropDuplicates()


def latest_revision(rows: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key: the first by ``newest_first``.

    Columns not named there break ties, so the choice is the same on every run. A hot key never
    reaches one task as a whole (see :func:`first_rows`).
    """
    others = [F.desc(name) for name in rows.columns if name not in keys]
    return first_rows(rows, keys, [*newest_first, *others], 1, "_position").drop("_position")


def first_rows(
    rows: DataFrame, per: list[str], order: list[Column | str], n: int, position: str
) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, with their 1-based ``position``.

    Each group is cut into as many slices as shuffles have tasks, by a hash of the row; the first
    ``n`` of every slice are chosen first, and of these the first ``n`` of the group. So no task holds
    a whole group, for any ``n`` and whatever the session's limit on window group limits. Where
    that limit allows it, Spark also cuts each slice before the shuffle.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Columns of doubles may differ in their last bit when a lost task runs again.
    spread = [
        f"`{field.name}`" for field in rows.schema.fields
        if field.name not in per
        and not isinstance(field.dataType, (T.FractionalType, T.MapType, T.VariantType))
    ]
    slice_ = F.pmod(F.xxhash64(*spread), F.lit(slices)) if spread else F.lit(0).cast("long")
    sliced = Window.partitionBy(*per, "_slice").orderBy(*order)
    whole = Window.partitionBy(*per).orderBy(*order)
    return (
        rows.withColumn("_slice", slice_)
        .withColumn(position, F.row_number().over(sliced))
        .where(F.col(position) <= n)
        .drop("_slice", position)
        .withColumn(position, F.row_number().over(whole))
        .where(F.col(position) <= n)
    )


def numeric_columns(rows: DataFrame, skip=()) -> list[str]:
    """Names of numeric columns, found in the schema."""
    return [
        field.name
        for field in rows.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in skip
    ]


def within_range(
    rows: DataFrame, column: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; the comparison reaches the scan."""
    if start is not None:
        rows = rows.where(F.col(column) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(column) <= F.lit(end))
    return rows


def doubles(rows: DataFrame) -> DataFrame:
    """Decimal measures as doubles; other columns as they are."""
    return rows.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(f"`{field.name}`")
            for field in rows.schema.fields
        ]
    )
