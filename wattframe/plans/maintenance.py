"""Keeping cleaned rows and result tables up to date by the years that new rows touch.

Cleaned rows and tables are stored with snapshots (:mod:`wattframe.sources.snapshots`), one part per year. What
the pick-up has landed since the last run is reduced to the rows that are new; their years are the
touched ones. The new rows are appended to the cleaned ones, and of each table only the years that the
touched ones reach are worked out again, from the cleaned rows of those years. All other years keep
their files. Shares, sums and wide tables stay within a year; a change against the previous row reaches
from a touched year to the next year of the same series.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.operators.rows import distinct_rows
from wattframe.plans.cleaning import CLEANING
from wattframe.plans.refresh import clean_path, table_path
from wattframe.plans.serving import with_place
from wattframe.plans.tables import RESULT_TABLES
from wattframe.session import keep
from wattframe.sources import snapshots
from wattframe.sources.catalog import SOURCES, TABLES
from wattframe.sources.files import read_csv
from wattframe.streaming.pickup import batch_parts, read_batches, year_of

BATCHES = "batches"
#: Tables whose rows look back at the previous year of a series, and the series.
LOOK_BACK: dict[str, list[str]] = {"seds_state_pct_us": ["state_id"]}


@dataclass(frozen=True)
class Maintained:
    """What a run has changed: batches read, years with new rows, years rewritten per table."""

    batches: list[str] = field(default_factory=list)
    touched: list[str] = field(default_factory=list)
    rewritten: dict[str, list[str]] = field(default_factory=dict)


def part_of(rows: DataFrame) -> Column:
    """The part of a row: its calendar year; rows without one share a part."""
    return F.coalesce(year_of(rows).cast("string"), F.lit(snapshots.NO_PART))


def tables_of(source: str) -> list[str]:
    return [name for name, (needs, _) in RESULT_TABLES.items() if needs == source]


def _built(name: str, clean: DataFrame) -> DataFrame:
    return with_place(RESULT_TABLES[name][1](clean), TABLES[name])


def rebuild(
    spark: SparkSession, base: str, source: str, newest_only: bool = False, picked_up: str | None = None
) -> list[str]:
    """Clean all raw files of a source, and what was picked up, and rebuild its tables.

    Readers go on with the old tables until each is replaced. Returns the names of the tables.
    """
    raw = read_csv(spark, f"{base.rstrip('/')}/{SOURCES[source].raw_prefix}", newest_only=newest_only)
    rows, batches = CLEANING[source](raw), sorted(batch_parts(spark, picked_up)) if picked_up else []
    if batches:
        landed = read_batches(spark, picked_up, batches)
        rows = distinct_rows(rows.unionByName(landed.select(*rows.columns)))
    clean = keep(rows)
    snapshots.replace(clean, clean_path(base, source), part_of(clean), notes={BATCHES: batches})
    clean = snapshots.read(spark, clean_path(base, source))
    for name in tables_of(source):
        table = _built(name, clean)
        snapshots.replace(table, table_path(base, name), part_of(table), sort=TABLES[name].sort)
    return tables_of(source)


def _neighbours(places: DataFrame, known: DataFrame, series: list[str], later: bool) -> list[int]:
    """Years next to the given places of series: the nearest later (or earlier) one with rows.

    Both tables have the series' columns and ``year``. What is collected are calendar years.
    """
    near = places.select(*series, F.col("year").alias("_at")).join(known, series)
    beyond = near.where(F.col("year") > F.col("_at") if later else F.col("year") < F.col("_at"))
    nearest = F.min("year") if later else F.max("year")
    found = beyond.groupBy(*series, "_at").agg(nearest.alias("year")).select("year").distinct()
    return [row[0] for row in found.toLocalIterator()]


def reach(
    name: str, stored: DataFrame, fresh: DataFrame, touched: list[str], parts: list[str]
) -> tuple[list[str], list[str]]:
    """Parts of a table to work out again, and the parts of cleaned rows that this takes.

    ``stored`` is the table, ``fresh`` the new cleaned rows, ``parts`` all parts there are.
    """
    if name not in LOOK_BACK:
        return touched, touched
    if snapshots.NO_PART in touched:
        return parts, parts
    series = LOOK_BACK[name]
    old, new = (
        rows.select(*series, F.col("year").cast("int").alias("year")).where("year IS NOT NULL").distinct()
        for rows in (stored, fresh)
    )
    known = keep(old.union(new).distinct())
    again = sorted({*map(int, touched), *_neighbours(new, known, series, later=True)})
    needed = sorted({*again, *_neighbours(known.where(F.col("year").isin(again)), known, series, later=False)})
    return [str(year) for year in again], [str(year) for year in needed]


def maintain(spark: SparkSession, base: str, source: str, picked_up: str) -> Maintained:
    """Take over what the pick-up has landed since the last run, touching only the years it reaches.

    ``picked_up`` is the table of :func:`wattframe.streaming.pickup.pick_up`. Only its new batches are
    read, and compared with the cleaned rows of their years. The cleaned rows' next snapshot, which also
    notes the batches, is the last step: a run that fails before is simply repeated. Tables that do not
    exist yet are built as a whole.
    """
    at = clean_path(base, source)
    before = snapshots.current(spark, at)
    done = set(before.notes.get(BATCHES, [])) if before else set()
    waiting = {batch: years for batch, years in batch_parts(spark, picked_up).items() if batch not in done}
    if not waiting:
        return Maintained()
    landed = read_batches(spark, picked_up, list(waiting))
    if before is None:
        fresh = keep(distinct_rows(landed))
    else:
        columns = before.schema.names
        years = sorted(set().union(*waiting.values()))
        fresh = keep(landed.select(*columns).subtract(snapshots.read(spark, at, before, years).select(*columns)))
    written = snapshots.write_parts(fresh, at, part_of(fresh))
    touched = sorted(written.parts)
    rewritten = {}
    if touched:
        stored = {**before.parts} if before else {}
        parts = {p: [*stored.get(p, []), *written.parts.get(p, [])] for p in {*stored, *written.parts}}
        schema = before.schema if before else written.schema
        after = snapshots.Snapshot(0, parts, schema.json())  # as it will be, not yet named
        for name in tables_of(source):
            rewritten[name] = _rewritten(spark, base, name, after, fresh, touched)
    notes = {BATCHES: sorted(done | set(waiting))}
    snapshots.commit(spark, at, written, before, append=True, notes=notes)
    return Maintained(sorted(waiting), touched, rewritten)


def _rewritten(
    spark: SparkSession,
    base: str,
    name: str,
    after: snapshots.Snapshot,
    fresh: DataFrame,
    touched: list[str],
) -> list[str]:
    at, clean_at = table_path(base, name), clean_path(base, RESULT_TABLES[name][0])
    table = snapshots.current(spark, at)
    again = needed = sorted(after.parts)
    if table is not None:
        again, needed = reach(name, snapshots.read(spark, at, table), fresh, touched, again)
    built = _built(name, snapshots.read(spark, clean_at, after, needed))
    if set(needed) != set(again):
        built = built.where(part_of(built).isin(again))
    snapshots.replace(built, at, part_of(built), replaced=again if table else None, sort=TABLES[name].sort)
    return again
