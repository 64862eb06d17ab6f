"""Change against the previous row of a series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.measures import percent
from wattframe.session import keep


def change_from_previous(
    groups: DataFrame,
    series: list[str],
    time: str,
    value: str,
    *,
    change: str,
    change_pct: str,
    digits: int = 2,
    ties: tuple[str, ...] = (),
    consecutive_only: bool = False,
) -> DataFrame:
    """Absolute and percentage change per series, over grouped rows.

    The previous row counts, also across a gap in time; ``consecutive_only`` leaves the change
    NULL after a gap. ``ties`` orders rows of the same time, so that the result is repeatable.
    Both lags share one window, hence one shuffle and one sort. A series has one row per time (and
    tie), never raw facts.
    """
    order = Window.partitionBy(*series).orderBy(time, *ties)
    previous = F.lag(value).over(order)
    if consecutive_only:
        previous = F.when(F.col(time) - F.lag(time).over(order) == 1, previous)
    return _with_change(groups.withColumn("_previous", previous), value, change, change_pct, digits)


def _with_change(groups: DataFrame, value: str, change: str, change_pct: str, digits: int) -> DataFrame:
    return (
        groups.withColumn(change, F.col(value) - F.col("_previous"))
        .withColumn(change_pct, percent(change, "_previous", digits))
        .drop("_previous")
    )


def change_in_long_series(
    rows: DataFrame,
    series: list[str],
    time: str,
    value: str,
    *,
    change: str,
    change_pct: str,
    digits: int = 2,
    ties: tuple[str, ...] = (),
    consecutive_only: bool = False,
) -> DataFrame:
    """The same as :func:`change_from_previous`, for series that no task should hold: raw rows, or one
    series that is most of the table.

    The rows are range-sorted by series, time and ties, so a long series lies in many partitions. A
    row is compared with the one before it in its partition; the first of a partition with the last of
    the partition before, and of these there is one row per partition (broadcast, whatever the
    data). ``series`` may be empty: one series. Rows equal in all of these follow each other by their other
    columns, so that the result is repeatable and ties split, too; all columns must be orderable.
    """
    named = [*series, time, *ties]
    order = [*named, *[name for name in rows.columns if name not in named]]
    # Kept before the sort, which samples them: a task that runs again must find the same rows.
    kept = keep(rows)
    placed = keep(kept.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    # The upper 31 bits of the id are the partition, the lower 33 the row's place in it.
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    row = F.struct(
        *[F.col(name).alias(f"series_{i}") for i, name in enumerate(series)],
        F.col(time).alias("time"), F.col(value).alias("value"),
    )
    last = placed.groupBy("_part").agg(F.max_by(row, "_id").alias("_last"))
    carried = last.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_carried"))
    is_first = F.col("_id").bitwiseAND((1 << 33) - 1) == 0
    within = F.lag(row).over(Window.partitionBy("_part").orderBy("_id"))
    before = (
        placed.withColumn("_before", within)
        .join(F.broadcast(carried), "_part")
        .withColumn("_before", F.when(is_first, F.col("_carried")).otherwise(F.col("_before")))
    )
    counts = [F.col(f"_before.series_{i}").eqNullSafe(F.col(name)) for i, name in enumerate(series)]
    if consecutive_only:
        counts.append(F.col(time) - F.col("_before.time") == 1)
    previous = F.col("_before.value")
    if counts:
        previous = F.when(reduce(lambda a, b: a & b, counts), previous)
    with_previous = before.select(*rows.columns, previous.alias("_previous"))
    return _with_change(with_previous, value, change, change_pct, digits)
