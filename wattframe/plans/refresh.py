"""Full refresh: raw files -> cleaned Parquet -> result tables.

Cleaned rows are written once per source and every table of the source reads that copy, so raw
text is parsed and deduplicated once, however many tables come from it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions.calendar import ANNUAL, MONTHLY
from wattframe.operators.rows import distinct_rows, within_range
from wattframe.plans.cleaning import CLEANING
from wattframe.plans.serving import with_place
from wattframe.plans.tables import RESULT_TABLES
from wattframe.session import keep
from wattframe.sources.catalog import SOURCES, TABLES, SourceSpec
from wattframe.sources.files import read_csv, read_table, write_table
from wattframe.sources.manifest import read_known, update_manifest
from wattframe.streaming.pickup import read_picked_up


def clean_path(base: str, source: str) -> str:
    return f"{base.rstrip('/')}/clean/{source}"


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/processed/{TABLES[table].path}"


def manifest_path(base: str, source: str) -> str:
    return f"{base.rstrip('/')}/manifest/{source}"


def clean_range(
    clean: DataFrame, source: SourceSpec, start: str | None, end: str | None
) -> DataFrame:
    """Cleaned rows from ``start`` to ``end`` in the source's own period format."""
    if source.grain == ANNUAL:
        return within_range(clean, "year", *(int(p[:4]) if p else None for p in (start, end)))
    first = f"{start}-01" if start and len(start) == 7 else start
    rows = within_range(clean, "period", first and F.to_date(F.lit(first)))
    if not end:
        return rows
    if len(end) == 7:
        last = F.last_day(F.to_date(F.lit(f"{end}-01")))
    else:
        last = F.to_date(F.lit(end))
        if source.grain == MONTHLY:
            last = F.last_day(last)
    return within_range(rows, "period", end=last)


def build_tables(clean: DataFrame, source: str, out: str) -> list[str]:
    """Write every result table of a source from its cleaned rows, which should be stored: several
    tables read them. Returns the names of the tables."""
    written = [name for name, (needs, _) in RESULT_TABLES.items() if needs == source]
    for name in written:
        build = RESULT_TABLES[name][1]
        spec = TABLES[name]
        write_table(with_place(build(clean), spec), table_path(out, name), sort=spec.sort)
    return written


def refresh_source(
    spark: SparkSession,
    base: str,
    name: str,
    start: str | None = None,
    end: str | None = None,
    newest_only: bool = False,
    out: str | None = None,
    manifest: bool = False,
) -> list[str]:
    """Clean one source and rebuild its tables; returns the names of the tables written.

    With ``manifest`` a manifest of the raw files is kept next to them: the headers of known files are
    not looked up again, and files outside the range are not opened.

    ``start`` and ``end`` limit what is processed, so cleaned rows and tables hold that range only.
    They would replace the whole history, so a range needs an ``out`` apart from ``base``.
    Continuous loads go through the streaming pick-up and :func:`add_picked_up`.
    """
    if (start or end) and (out is None or out.rstrip("/") == base.rstrip("/")):
        raise ValueError("a refresh of a range needs a place of its own: name it with out")
    out = out or base
    source = SOURCES[name]
    root = f"{base.rstrip('/')}/{source.raw_prefix}"
    if manifest:
        update_manifest(spark, root, manifest_path(base, name))
        raw = read_known(spark, manifest_path(base, name), start, end, newest_only=newest_only)
    else:
        raw = read_csv(spark, root, newest_only=newest_only)
    write_table(clean_range(CLEANING[name](raw), source, start, end), clean_path(out, name))
    return build_tables(read_table(spark, clean_path(out, name)), name, out)


def add_picked_up(
    spark: SparkSession, base: str, name: str, picked_up: str, out: str | None = None
) -> list[str]:
    """Add what the pick-up of a source has landed to its cleaned rows and rebuild its tables.

    ``picked_up`` is the table that :func:`wattframe.streaming.pickup.pick_up` writes. Rows that are
    cleaned already count once; without cleaned rows so far, the picked-up ones are all. The history
    is kept: result tables hold shares and changes that reach over years, so they are built from all
    cleaned rows. Returns the names of the tables written.
    """
    out = out or base
    landed = read_picked_up(spark, picked_up)
    try:
        stored = read_table(spark, clean_path(base, name))
        landed = stored.unionByName(landed.select(*stored.columns))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    # Written apart first: the cleaned rows cannot be read and replaced at once.
    write_table(keep(distinct_rows(landed)), clean_path(out, name))
    return build_tables(read_table(spark, clean_path(out, name)), name, out)


def refresh(spark: SparkSession, base: str, names: list[str] | None = None, **options) -> list[str]:
    """Refresh the given sources, or all that have a cleaning step."""
    return [
        table
        for name in (names or list(CLEANING))
        for table in refresh_source(spark, base, name, **options)
    ]
