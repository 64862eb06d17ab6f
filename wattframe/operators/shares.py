"""Share of a total: rows or groups, next to the total of the larger group they belong to.

Totals come by aggregate and join, not by a window: the aggregate combines on the map side, no
task has to hold a whole group, and a NULL key keeps a NULL total.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.functions.measures import percent
from wattframe.session import keep

SLICES = 16
SLICE_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
FIELD_BYTES = 16


def keep_measured(table: DataFrame) -> tuple[DataFrame, int]:
    """The table computed once and kept, and its size in memory: fixed fields and bytes of texts.

    The kept copy serves whatever follows from the size, so the check costs no second computation.
    """
    kept = keep(table)
    widths = [
        F.coalesce(F.octet_length(name), F.lit(0)) + FIELD_BYTES if kind == "string"
        else F.lit(FIELD_BYTES)
        for name, kind in kept.dtypes
    ]
    row_bytes = reduce(lambda a, b: a + b, widths).cast("long")
    return kept, kept.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]


def join_totals_sliced(
    rows: DataFrame,
    totals: DataFrame,
    keys: list[str],
    spread_by: list[str] | None = None,
    counted: str | None = None,
) -> DataFrame:
    """Left join to unique totals that survives one key holding much of the rows.

    A key is cut into slices by a hash of ``spread_by`` (the row's other columns), and its total is
    repeated once per slice. Both sides then have an exchange of their own right below the
    join, which is what AQE needs to cut a partition that is still too large, or to turn the join
    into a broadcast when the totals prove small.

    ``counted`` names the column of ``totals`` with the number of rows of the key; it is not part of
    the result. Only keys of more than ``SLICE_ROWS`` rows are then cut, into slices of about that
    many, and all other totals stay single. The list of such keys is broadcast: it has less than
    one entry for ``SLICE_ROWS`` rows. Without the counts every key has ``SLICES`` slices.

    Keys compare NULL-safe and the totals of NULL keys are blanked afterwards. A plain left join
    gives the same rows, but Catalyst would push its not-null test into the totals' side only, and
    two sides that come from the same rows could then no longer share one exchange.
    """
    if spread_by is None:
        spread_by = [name for name in rows.columns if name not in keys]
    total_names = [name for name in totals.columns if name not in keys and name != counted]
    of_keys = {key: f"_of_{key}" for key in [*keys, "_slice"]}
    matches = [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    spread = F.xxhash64(*spread_by) if spread_by else F.lit(0).cast("long")
    if counted is None:
        slices = F.lit(SLICES).cast("long")
        sliced_rows = rows.withColumn("_slice", F.pmod(spread, slices))
    else:
        slices = F.ceil(F.col(counted) / SLICE_ROWS)
        # The totals are named in a test that all pass: needing the same columns as the other side,
        # the list reads the same exchange and no second scan is made for it.
        named = F.hash(*total_names).cast("string") != ""
        large = totals.where((F.col(counted) > SLICE_ROWS) & named)
        large = large.select(*keys, slices.alias("_slices")).withColumnsRenamed(of_keys)
        listed = rows.join(F.broadcast(large), matches, "left")
        number = F.pmod(spread, F.coalesce("_slices", F.lit(1).cast("long")))
        sliced_rows = listed.select(*rows.columns, number.alias("_slice"))
    sliced_totals = totals.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))
    sliced_totals = sliced_totals.select(*keys, *total_names, "_slice").withColumnsRenamed(of_keys)
    matches = [*matches, F.col("_slice") == F.col("_of__slice")]
    has_key = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    return sliced_rows.join(sliced_totals, matches, "left").select(
        *rows.columns, *[F.when(has_key, F.col(name)).alias(name) for name in total_names]
    )


def join_totals(
    rows: DataFrame, totals: DataFrame, keys: list[str], counted: str | None = None
) -> DataFrame:
    """Left join of un-aggregated rows to unique totals without moving the rows, if possible.

    The totals are computed first and broadcast when their measured size allows it, so the rows
    are only scanned. Beyond the bound the sliced join takes over (see there for ``counted``).
    """
    kept, size = keep_measured(totals)
    if size <= MAX_BROADCAST_BYTES:
        joined = rows.join(F.broadcast(kept), keys, "left")
        added = [name for name in kept.columns if name not in keys and name != counted]
        return joined.select(*[F.col(f"`{name}`") for name in [*rows.columns, *added]])
    return join_totals_sliced(rows, kept, keys, counted=counted)


def row_share(
    rows: DataFrame,
    value: str,
    within: list[str],
    *,
    total: str,
    share: str,
    digits: int = 4,
) -> DataFrame:
    """Each row's share of the total of its ``within`` group; the rows stay as they are."""
    totals = rows.groupBy(*within).agg(F.sum(value).alias(total), F.count("*").alias("_rows"))
    return join_totals(rows, totals, within, "_rows").withColumn(share, percent(value, total, digits))


def group_share(
    groups: DataFrame,
    value: str,
    within: list[str],
    *,
    total: str,
    share: str,
    digits: int = 4,
    more_totals: dict[str, Column] | None = None,
    member: Column | None = None,
) -> DataFrame:
    """Share of already grouped rows in the total of their ``within`` group.

    The totals are summed from the groups themselves, so both join sides share one scan and one
    exchange of the facts. ``member`` restricts what counts as the total, such as a published
    national row; without a row of it the total is NULL. It is a condition inside the sum and not
    a filter for the same reason: a filter would reach the scan and make a second one.
    """
    counted = F.col(value) if member is None else F.when(member, F.col(value))
    totals = groups.groupBy(*within).agg(
        F.sum(counted).alias(total),
        F.count("*").alias("_rows"),
        *[column.alias(name) for name, column in (more_totals or {}).items()],
    )
    # Sums of doubles may differ in their last bit when a lost task runs again, so they must not
    # decide where a group goes.
    exact = [
        field.name
        for field in groups.schema.fields
        if field.name not in within and not isinstance(field.dataType, T.FractionalType)
    ]
    return join_totals_sliced(groups, totals, within, exact, "_rows").withColumn(
        share, percent(value, total, digits)
    )
