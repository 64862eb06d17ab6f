"""Typing of raw text columns. Malformed text gives NULL and never an error, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(source: str | Column) -> Column:
    """Raw headers carry hyphens, which a bare name in ``F.col`` takes as they are."""
    return F.col(source) if isinstance(source, str) else source


def number(source: str | Column, kind: str = "double") -> Column:
    """Text to a measure. ``kind`` may be a decimal type when sums have to be bit-stable.

    ``NaN`` and ``Infinity`` are no measures: one would spoil every total of its group.
    """
    value = _column(source).try_cast(kind)
    if kind not in ("double", "float"):
        return value
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def whole(source: str | Column) -> Column:
    """Text to int through double, so that ``12.0`` gives 12; fractions are cut off."""
    return _column(source).try_cast("double").try_cast("int")


def year_number(source: str | Column) -> Column:
    """``yyyy`` text to int."""
    return _column(source).try_cast("int")


def month_start(source: str | Column) -> Column:
    """``yyyy-MM`` text to the first day of that month."""
    return F.try_to_date(_column(source), "yyyy-MM")


def day(source: str | Column) -> Column:
    """``yyyy-MM-dd`` text to a date."""
    return F.try_to_date(_column(source), "yyyy-MM-dd")


def trimmed(source: str | Column) -> Column:
    return F.trim(_column(source))


def code_part(source: str | Column, start: int, length: int) -> Column:
    """Characters of a positional code; ``start`` counts from 1."""
    return F.substring(_column(source), start, length)
