"""Long to wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.functions.measures import percent

PIVOT_LIMIT = "spark.sql.pivotMaxValues"


def pivot_named(
    rows: DataFrame, keys: list[str], code: str, value: str, columns: dict[str, str]
) -> DataFrame:
    """Sum of ``value`` per key, one named column per known code; NULL where a code is absent.

    Rows with other codes do not count, not even as a key. One conditional aggregate: map-side
    combine and a single shuffle, where a pivot would take two.
    """
    return (
        rows.where(F.col(code).isin(list(columns)))
        .groupBy(*keys)
        .agg(
            *[
                F.sum(F.when(F.col(code) == known, F.col(value))).alias(name)
                for known, name in columns.items()
            ]
        )
    )


def discover_codes(rows: DataFrame, code: str, limit: int | None = None) -> list[str]:
    """Codes present, sorted. They become column names, so too many are an error, never a cut.

    How many are too many is the session's own setting for pivots, unless the caller says. For any
    number of codes there is :func:`sums_by_code`.
    """
    if limit is None:
        limit = int(rows.sparkSession.conf.get(PIVOT_LIMIT))
    found = (
        rows.where(F.col(code).isNotNull())
        .select(code)
        .distinct()
        .orderBy(code)
        .limit(limit + 1)
        .collect()
    )
    if len(found) > limit:
        raise ValueError(f"more than {limit} different values of {code} cannot become columns")
    return [row[0] for row in found]


def pivot_discovered(
    rows: DataFrame, keys: list[str], code: str, value: str, codes: list[str] | None = None
) -> DataFrame:
    """Sum of ``value`` per key, one column per code found in the data (or given)."""
    if codes is None:
        codes = discover_codes(rows, code)
    if not codes:
        return rows.select(*keys).distinct()
    return rows.groupBy(*keys).pivot(code, codes).agg(F.sum(value))


def pivot_share(
    rows: DataFrame,
    keys: list[str],
    code: str,
    value: str,
    base: str,
    digits: int = 2,
    codes: list[str] | None = None,
) -> DataFrame:
    """:func:`pivot_discovered` plus ``<code>_pct`` of the ``base`` column for every other code."""
    if codes is None:
        codes = discover_codes(rows, code)
    wide = pivot_discovered(rows, keys, code, value, codes)
    if base not in codes:
        return wide
    shares = [
        percent(_quoted(other), _quoted(base), digits).alias(f"{other.lower()}_pct")
        for other in codes
        if other != base
    ]
    return wide.select("*", *shares)


def sums_by_code(rows: DataFrame, keys: list[str], code: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` per key and code as one map column ``name``: as many codes as there are.

    Rows without a code do not count, but their key stays, with an empty map if it has no others.
    """
    sums = rows.groupBy(*keys, code).agg(F.sum(value).alias("_sum"))
    entries = F.collect_list(F.when(F.col(code).isNotNull(), F.struct(code, "_sum")))
    return sums.groupBy(*keys).agg(F.map_from_entries(F.array_sort(entries)).alias(name))


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def unpivot_labelled(
    wide: DataFrame, keys: list[str], labels: dict[str, str], name: str, value: str
) -> DataFrame:
    """Wide to long, with each column's label next to its name (``<name>_label``)."""
    long = wide.unpivot(keys, [_quoted(column) for column in labels], name, value)
    label = F.create_map(*[F.lit(part) for pair in labels.items() for part in pair])[F.col(name)]
    return long.withColumn(f"{name}_label", label)
