"""Calendar columns and period labels."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKLY, MONTHLY, ANNUAL = "weekly", "monthly", "annual"


def calendar_columns(period: Column, grain: str) -> dict[str, Column]:
    """Calendar attributes of a date at its grain: ISO year and week, or year and month."""
    if grain == WEEKLY:
        return {
            "year": F.extract(F.lit("YEAROFWEEK"), period).cast("int"),
            "week": F.weekofyear(period),
        }
    if grain == MONTHLY:
        return {"year": F.year(period), "month": F.month(period)}
    raise ValueError(f"no calendar columns for grain {grain!r}")


def period_bounds(
    grain: str, year: int, month: int | None = None, week: int | None = None
) -> tuple[date, date]:
    """First day, and day after the last, of a year, a month or an ISO week.

    A slice given as a date range reaches the Parquet scan and skips row groups, which
    ``year(period) = y`` would not. A week that its ISO year does not have is an empty range.
    """
    if grain == WEEKLY:
        first = date.fromisocalendar(year, 1, 1)
        after = date.fromisocalendar(year + 1, 1, 1)
        if week is None:
            return first, after
        start = min(first + timedelta(weeks=max(week, 1) - 1), after)
        return start, (min(start + timedelta(weeks=1), after) if week >= 1 else start)
    if month is None:
        return date(year, 1, 1), date(year + 1, 1, 1)
    if not 1 <= month <= 12:
        return date(year, 1, 1), date(year, 1, 1)
    return date(year, month, 1), (date(year, month + 1, 1) if month < 12 else date(year + 1, 1, 1))


def period_label(grain: str, period: Column | None = None, year: Column | None = None) -> Column:
    """``March 2024``, ``Week 5, 2024`` or ``2024``."""
    if grain == MONTHLY:
        return F.date_format(period, "MMMM yyyy")
    if grain == WEEKLY:
        parts = calendar_columns(period, WEEKLY)
        return F.concat(
            F.lit("Week "), parts["week"].cast("string"), F.lit(", "), parts["year"].cast("string")
        )
    return year.cast("string")
