"""The order in which tables are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_columns(names) -> list[Column]:
    """``-name`` sorts descending."""
    return [
        F.desc(f"`{name[1:]}`") if name.startswith("-") else F.asc(f"`{name}`") for name in names
    ]


def in_order(table: DataFrame, sort) -> DataFrame:
    """Range partitions by the sort key, each sorted, so that a slice of it skips most of the files.

    The other columns follow in the key: distinct rows then never tie, and a sort key that much of the
    table shares still splits evenly.
    """
    named = {name.removeprefix("-") for name in sort}
    rest = [name for name in table.columns if name not in named]
    return table.orderBy(*sort_columns([*sort, *rest]))
