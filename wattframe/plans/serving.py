"""Read side: load a result table, slice it by time, sum, rank and trend it.

Everything is lazy: slice and column pruning reach the Parquet scan, and so does the place filter
where the table was stored with its places in one spelling, as a refresh does (:func:`with_place`).
Sums take whatever metric is chosen, as published dashboards do; ``agg`` replaces the sum where
``TableSpec.additive`` is False.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions.calendar import ANNUAL, MONTHLY, WEEKLY, calendar_columns, period_bounds
from wattframe.functions.fixed_values import NO_METRICS
from wattframe.functions.labels import column_label, place_name, readable, state_code
from wattframe.operators.ranking import aggregated, rank_all, sum_by, top_n, top_n_per
from wattframe.operators.rows import distinct_rows, numeric_columns
from wattframe.sources.catalog import TableSpec
from wattframe.sources.files import read_table

PLACE = "state"
STORED_PLACE = "place"
TOP_PLACES, TOP_BREAKDOWN = 15, 10


def _place(table: DataFrame, spec: TableSpec) -> Column | None:
    """The place in one spelling. State and electricity tables fall back to ``state_id`` where
    ``state_name`` is missing."""
    spellings = [spec.place, "state_id"] if spec.place == "state_name" else [spec.place]
    spellings = [name for name in spellings if name in table.columns]
    return place_name(F.coalesce(*spellings)) if spellings else None


def with_place(table: DataFrame, spec: TableSpec) -> DataFrame:
    """The table with its place in one spelling as a column of its own, to be stored.

    A filter on a stored column skips row groups; one on a spelling worked out by reading cannot.
    """
    place = _place(table, spec)
    if place is None or STORED_PLACE in table.columns:
        return table
    return table.withColumn(STORED_PLACE, place)


def prepare(table: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct rows, the place column as ``state`` in one spelling, calendar columns.

    Rows whose time did not parse are dropped. A NULL place stays NULL.
    """
    rows = table if spec.unique_rows else distinct_rows(table)
    if STORED_PLACE in rows.columns and spec.place != STORED_PLACE:
        rows = rows.drop(PLACE, spec.place).withColumnRenamed(STORED_PLACE, PLACE)
    elif (place := _place(rows, spec)) is not None:
        rows = rows.withColumn(PLACE, place)
        if spec.place != PLACE:
            rows = rows.drop(spec.place)
    if spec.grain in (WEEKLY, MONTHLY) and "period" in rows.columns:
        rows = rows.withColumn("period", F.col("period").try_cast("date"))
        rows = rows.where(F.col("period").isNotNull())
        return rows.withColumns(calendar_columns(F.col("period"), spec.grain))
    if spec.grain == ANNUAL and "year" in rows.columns:
        rows = rows.withColumn("year", F.col("year").try_cast("int"))
        return rows.where(F.col("year").isNotNull())
    return rows


def load(spark: SparkSession, spec: TableSpec, base: str) -> DataFrame:
    """A stored table, prepared for queries."""
    return prepare(read_table(spark, f"{base.rstrip('/')}/{spec.path}"), spec)


def time_slice(
    rows: DataFrame,
    spec: TableSpec,
    year: int,
    month: int | None = None,
    week: int | None = None,
) -> DataFrame:
    """Rows of a year and, by grain, of a month or an ISO week. No aggregation."""
    if spec.grain == ANNUAL:
        return rows.where(F.col("year") == year)
    first, after = period_bounds(
        spec.grain, year, month if spec.grain == MONTHLY else None,
        week if spec.grain == WEEKLY else None,
    )
    return rows.where((F.col("period") >= F.lit(first)) & (F.col("period") < F.lit(after)))


def choices(rows: DataFrame, column: str) -> DataFrame:
    """Values present in a calendar column, newest first."""
    return (
        rows.where(F.col(column).isNotNull()).select(column).distinct().orderBy(F.desc(column))
    )


def metrics(rows: DataFrame, spec: TableSpec) -> dict[str, str]:
    """Label -> column of the metrics of a table, as its catalog entry describes them.

    An entry without any described metric stands for a wide table: each numeric column that is not
    part of the key is a metric then, labelled by its code if the entry says that columns are codes.
    """
    numeric = numeric_columns(rows)
    described = {
        label: name for name, label in spec.described_metrics.items()
        if name == spec.value or name in numeric
    }
    label = column_label if spec.columns_are_codes else readable
    return described or {label(name): name for name in numeric if name not in NO_METRICS}


def dimension(rows: DataFrame, spec: TableSpec) -> str | None:
    """What to group by: the place, else the breakdown, else the raw place column."""
    for name in (PLACE, spec.breakdown, spec.place):
        if name and name in rows.columns:
            return name
    return None


def metric_or_default(rows: DataFrame, spec: TableSpec, metric: str | None) -> str | None:
    """The chosen metric if it is numeric here, else the declared value."""
    if metric and metric in numeric_columns(rows):
        return metric
    return spec.value or spec.breakdown_value


def by_place(rows: DataFrame, metric: str | None, agg=F.sum) -> DataFrame:
    """One value per place; rows pass unchanged when there is no place or no such metric."""
    if PLACE not in rows.columns or metric not in numeric_columns(rows):
        return rows
    return sum_by(rows, [PLACE], metric, agg)


def states_only(rows: DataFrame) -> DataFrame:
    """Rows whose place is a state, with its two-letter code."""
    return rows.withColumn("state_abbrev", state_code(F.col(PLACE))).where(
        F.col("state_abbrev").isNotNull()
    )


def _group_and_metric(rows: DataFrame, spec: TableSpec, metric: str | None) -> tuple[str, str]:
    group, value = dimension(rows, spec), metric_or_default(rows, spec, metric)
    if group is None or value not in rows.columns:
        raise ValueError(f"{spec.name} has nothing to group by or no metric {metric!r}")
    return group, value


def top_places(
    rows: DataFrame, spec: TableSpec, metric: str | None, n: int = TOP_PLACES, agg=F.sum
) -> DataFrame:
    """The ``n`` largest places (or breakdown members) of a slice."""
    group, value = _group_and_metric(rows, spec, metric)
    return top_n(sum_by(rows, [group], value, agg), value, n, [group])


def snapshot(
    rows: DataFrame, spec: TableSpec, place: str, metric: str | None = None, agg=F.sum
) -> DataFrame:
    """One row about a place in a slice: the metric, numeric extras summed, text extras one value.

    Of several texts the smallest is taken, so that the answer does not depend on row order.
    """
    value = metric_or_default(rows, spec, metric)
    numeric = numeric_columns(rows)
    names = dict.fromkeys([value, *spec.extras])
    return rows.where(F.col(PLACE) == place).agg(
        *[
            aggregated(agg, name).alias(name) if name in numeric
            else F.min(name).alias(name)
            for name in names
            if name in rows.columns
        ]
    )


def trend(
    rows: DataFrame, spec: TableSpec, metric: str | None, place: str | None = None, agg=F.sum
) -> DataFrame:
    """The metric over time, of one place or of everything."""
    if place is not None:
        rows = rows.where(F.col(PLACE) == place)
    return sum_by(rows, [spec.time], metric_or_default(rows, spec, metric), agg).orderBy(spec.time)


def breakdown(
    rows: DataFrame, spec: TableSpec, place: str | None = None, n: int = TOP_BREAKDOWN, agg=F.sum
) -> DataFrame:
    """The ``n`` largest breakdown members of one place in a slice, or of every place at once."""
    member, value = spec.breakdown, spec.breakdown_value
    if not {member, value} <= set(rows.columns):
        raise ValueError(f"{spec.name} has no breakdown")
    if place is not None:
        groups = sum_by(rows.where(F.col(PLACE) == place), [member], value, agg)
        return top_n(groups, value, n, [member])
    return top_n_per(sum_by(rows, [PLACE, member], value, agg), [PLACE], value, n, [member])


def ranking(rows: DataFrame, spec: TableSpec, metric: str | None, agg=F.sum) -> DataFrame:
    """Every place (or breakdown member) of a slice with its 1-based position."""
    group, value = _group_and_metric(rows, spec, metric)
    return rank_all(sum_by(rows, [group], value, agg), [F.desc(value), F.asc(group)])
