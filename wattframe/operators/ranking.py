"""Top lists and full rankings of summed metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.operators.rows import first_rows
from wattframe.session import keep


def aggregated(agg, metric: str) -> Column:
    """``agg`` of a column; only a sum of nothing is zero."""
    return F.coalesce(agg(metric), F.lit(0)) if agg is F.sum else agg(metric)


def sum_by(rows: DataFrame, keys: list[str], metric: str, agg=F.sum) -> DataFrame:
    """One value per key. Rows with a NULL key do not count.

    An all-NULL group sums to zero. It has no average, smallest or largest value: these stay NULL.
    """
    present = rows
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(aggregated(agg, metric).alias(metric))


def top_n(groups: DataFrame, metric: str, n: int, ties: list[str]) -> DataFrame:
    """The ``n`` largest; each task keeps ``n`` rows, and names decide between equal values."""
    return groups.orderBy(F.desc(metric), *ties).limit(n)


def top_n_per(groups: DataFrame, per: list[str], metric: str, n: int, ties: list[str]) -> DataFrame:
    """The ``n`` largest of each ``per`` group with their position.

    Every group is cut to ``n`` rows per slice before its slices meet, so a group of any size is
    never brought together (see :func:`wattframe.operators.rows.first_rows`).
    """
    return first_rows(groups, per, [F.desc(metric), *ties], n, "position")


def rank_all(groups: DataFrame, order: list[Column], position: str = "position") -> DataFrame:
    """1-based position of every row under a total order, without a single-task window.

    The rows are range-sorted and kept; a row's position is its place in its own partition plus
    the number of rows in the partitions before it. Only one count per partition is broadcast.
    The groups themselves are kept first: the sort samples them, and a task that runs again after a
    loss must find the same sums.
    """
    groups = keep(groups)
    # The upper 31 bits of the id are the partition, the lower 33 the row's place in it.
    placed = keep(groups.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    partition = F.shiftright("_id", 33)
    counts = placed.groupBy(partition.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per sorted partition: bounded by the number of shuffle partitions, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return (
        placed.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .withColumn(position, F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1) + 1)
        .drop("_part", "_id", "_before")
    )
