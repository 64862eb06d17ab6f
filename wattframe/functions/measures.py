"""Aggregates and ratios over measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(source: str | Column) -> Column:
    return F.col(source) if isinstance(source, str) else source


def ratio(part: str | Column, base: str | Column) -> Column:
    """``part / base`` in double; NULL when the base is zero or either side is missing."""
    return F.try_divide(_column(part).cast("double"), _column(base).cast("double"))


def percent(part: str | Column, base: str | Column, digits: int) -> Column:
    """Rounded percentage, half up."""
    return F.round(ratio(part, base) * 100, digits)


def mean(source: str | Column) -> Column:
    """Unweighted mean as sum over count: exact for decimals, NULL for an all-NULL group."""
    column = _column(source)
    return ratio(F.sum(column), F.count(column))
