"""Which periods to load: latest stored period, step back, load ranges, run range."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattframe.functions.calendar import ANNUAL, MONTHLY
from wattframe.sources.catalog import SourceSpec


def latest_period(raw: DataFrame, period: str = "period") -> DataFrame:
    """One row with the largest period text; blanks and repeated headers do not count."""
    present = raw.where((F.trim(period) != "") & (F.col(period) != period))
    return present.agg(F.max(period).alias("latest"))


def step_back(latest: Column, grain: str, step: str) -> Column:
    """Start of the next incremental load: ``step`` (such as ``2 months``) before ``latest``.

    The overlap is there to pick up late revisions. Months give ``yyyy-MM``, weeks ``yyyy-MM-dd``;
    annual data steps by whole years. Month ends clamp, as in 31 March less one month.
    """
    amount_text, unit = step.split()
    amount = int(amount_text)
    if grain == ANNUAL:
        return (F.substring(latest, 1, 4).try_cast("int") - amount).cast("string")
    full = F.when(F.length(latest) > 7, latest).otherwise(F.concat(latest, F.lit("-01")))
    start = F.try_to_date(full, "yyyy-MM-dd")
    if unit.startswith("month"):
        return F.date_format(F.add_months(start, -amount), "yyyy-MM")
    if unit.startswith("week"):
        return F.date_format(F.date_sub(start, 7 * amount), "yyyy-MM-dd")
    if unit.startswith("year"):
        return F.date_format(F.add_months(start, -12 * amount), "yyyy-MM")
    return latest


def load_periods(start: Column, end: Column, grain: str) -> Column:
    """Array of the periods to load one by one, both ends included.

    Years for annual data, months otherwise (weekly data is loaded by month). Empty when the
    start lies after the end.
    """
    if grain == ANNUAL:
        first, last = (F.substring(c, 1, 4).try_cast("int") for c in (start, end))
        return F.when(
            first <= last, F.transform(F.sequence(first, last), lambda y: y.cast("string"))
        ).otherwise(F.array().cast("array<string>"))
    first, last = (F.try_to_date(F.substring(c, 1, 7), "yyyy-MM") for c in (start, end))
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.when(
        first <= last, F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))
    ).otherwise(F.array().cast("array<string>"))


def load_ranges(spark: SparkSession, start: str | None, end: str | None, grain: str) -> DataFrame:
    """``start, end`` of every load of a run; one (NULL, NULL) row when there is no start."""
    if start is None:
        return spark.range(1).select(
            F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("end")
        )
    periods = spark.range(1).select(
        F.explode(load_periods(F.lit(start), F.lit(end), grain)).alias("start")
    )
    return periods.select("start", F.col("start").alias("end"))


def missing_ranges(stored: DataFrame, start: str, end: str, grain: str, period: str = "period") -> DataFrame:
    """``start, end, periods`` of each gap: the longest runs of load periods without a stored row.

    ``stored`` has the periods that have been loaded, as text of the source's grain; weekly data counts
    by month, as it is loaded. Overlapping loads count once, malformed periods and those outside the range do
    not count. Nothing stored gives one range, nothing missing none. Runs come from the place of a missing
    period among all periods less its place among the missing ones, which is one number per run; both
    are lists of periods, not of rows.
    """
    width = 4 if grain == ANNUAL else 7
    wanted = stored.sparkSession.range(1).select(
        F.posexplode(load_periods(F.lit(start), F.lit(end), grain)).alias("place", "load")
    )
    loaded = stored.select(F.substring(F.trim(period), 1, width).alias("load")).distinct()
    missing = wanted.join(loaded, "load", "left_anti")
    run = F.col("place") - F.row_number().over(Window.orderBy("place"))  # calendar periods only
    return (
        missing.withColumn("_run", run)
        .groupBy("_run")
        .agg(F.min("load").alias("start"), F.max("load").alias("end"), F.count("*").alias("periods"))
        .drop("_run")
    )


def run_range(
    source: SourceSpec,
    run_day: date,
    *,
    given: tuple[str | None, str | None] = (None, None),
    override: tuple[str | None, str | None] = (None, None),
    incremental: bool = True,
    incremental_start: str | None = None,
) -> tuple[str | None, str | None]:
    """``(start, end)`` of a run.

    A complete range given with the run comes first, then a complete override. Otherwise the end is
    the run's own period and the start is the incremental one, if data is stored and the source
    has a start at all, or the source's default; a half override replaces its half.
    """
    for pair in (given, override):
        if pair[0] and pair[1]:
            return pair
    if source.grain == ANNUAL:
        end = f"{run_day:%Y}"
    elif source.grain == MONTHLY:
        end = f"{run_day:%Y-%m}"
    else:
        end = f"{run_day:%Y-%m-%d}"
    start = source.start
    if incremental and start is not None and incremental_start is not None:
        start = incremental_start
    return override[0] or start, override[1] or end
