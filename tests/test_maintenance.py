import os

import pytest
from pyspark.sql import functions as F

from wattframe.plans.cleaning import CLEANING
from wattframe.plans.maintenance import maintain, rebuild, tables_of
from wattframe.plans.refresh import clean_path, table_path
from wattframe.sources import snapshots
from wattframe.sources.catalog import SOURCES
from wattframe.sources.files import read_table
from wattframe.streaming.pickup import pick_up

SEDS = ["period", "stateId", "stateDescription", "seriesId", "seriesDescription", "value", "unit"]


def seds(*rows):
    lines = [f"{year},{state},{state}land,{series},s,{value},Btu" for year, state, series, value in rows]
    return ",".join(SEDS) + "\n" + "".join(line + "\n" for line in lines)


OLD = [(y, s, f, 100 * y % 977 + len(f) + ord(s[0])) for y in (2015, 2018, 2019, 2021, 2022)
       for s in ("TX", "OH", "UT") for f in ("TETCB", "COTCB") if (y, s) != (2019, "OH")]


def land(base, folder, name, text):
    os.makedirs(f"{base}/{folder}", exist_ok=True)
    with open(f"{base}/{folder}/{name}", "w") as file:
        file.write(text)


def picked(spark, base, source):
    columns = SEDS if source == "seds" else None
    pick_up(spark, f"{base}/landing", columns, CLEANING[source], f"{base}/picked", f"{base}/state").awaitTermination()


def contents(spark, path):
    frame = read_table(spark, path)
    return sorted(repr(sorted(row.asDict().items())) for row in frame.collect())


def times(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


@pytest.mark.parametrize(
    "new, touched, changes",
    [
        ([(2018, "OH", "TETCB", 5)], ["2018"], ["2018", "2021"]),  # Ohio has no row in 2019
        ([(2016, "NM", "TETCB", 5), (2018, "TX", "NGTCB", 5)], ["2016", "2018"], ["2016", "2018", "2019"]),
        ([(2023, "UT", "TETCB", 7), *OLD[:3]], ["2023"], ["2023"]),
    ],
)
def test_only_years_in_reach_are_rewritten(spark, tmp_path, new, touched, changes):
    base, other = str(tmp_path / "kept"), str(tmp_path / "whole")
    raw = SOURCES["seds"].raw_prefix
    land(base, raw, "a.csv", seds(*OLD))
    rebuild(spark, base, "seds")
    before = times(f"{base}/processed") | times(f"{base}/clean")
    land(base, "landing", "b.csv", seds(*new))
    picked(spark, base, "seds")
    done = maintain(spark, base, "seds", f"{base}/picked")
    assert (done.touched, len(done.batches)) == (touched, 1)
    assert set(done.rewritten["seds_state_pct_us"]) <= {*changes, *touched}
    assert done.rewritten["seds_fuel_pivot"] == done.rewritten["seds_state_consumption"] == touched

    land(other, raw, "all.csv", seds(*OLD, *new))
    rebuild(spark, other, "seds")
    assert contents(spark, clean_path(base, "seds")) == contents(spark, clean_path(other, "seds"))
    for name in tables_of("seds"):
        assert contents(spark, table_path(base, name)) == contents(spark, table_path(other, name)), name

    # Files of years out of reach are the ones from before, and still named by the snapshot.
    for name in tables_of("seds"):
        snapshot = snapshots.current(spark, table_path(base, name))
        for part, folders in snapshot.parts.items():
            now = times(f"{table_path(base, name)}/{folders[0]}")
            if part not in done.rewritten[name]:
                assert now.items() <= before.items()
            else:
                assert not set(now) & set(before)


def test_a_second_run_reads_and_writes_nothing(spark, tmp_path):
    base = str(tmp_path)
    land(base, SOURCES["seds"].raw_prefix, "a.csv", seds(*OLD))
    rebuild(spark, base, "seds")
    land(base, "landing", "b.csv", seds((2023, "UT", "TETCB", 7)))
    picked(spark, base, "seds")
    assert maintain(spark, base, "seds", f"{base}/picked").touched == ["2023"]
    number = snapshots.current(spark, clean_path(base, "seds")).number
    assert maintain(spark, base, "seds", f"{base}/picked").batches == []
    assert snapshots.current(spark, clean_path(base, "seds")).number == number
    # Rows that are known already touch no year, but their batch is noted.
    land(base, "landing", "c.csv", seds((2023, "UT", "TETCB", 7), *OLD[:2]))
    picked(spark, base, "seds")
    done = maintain(spark, base, "seds", f"{base}/picked")
    assert (len(done.batches), done.touched, done.rewritten) == (1, [], {})


def test_without_cleaned_rows_the_deliveries_are_all(spark, tmp_path):
    base = str(tmp_path)
    land(base, "landing", "b.csv", seds(*OLD))
    picked(spark, base, "seds")
    done = maintain(spark, base, "seds", f"{base}/picked")
    assert done.touched == ["2015", "2018", "2019", "2021", "2022"]
    assert read_table(spark, table_path(base, "seds_state_pct_us")).count() == 14


def test_undated_rows_have_a_part_of_their_own(spark, tmp_path):
    base = str(tmp_path)
    land(base, SOURCES["seds"].raw_prefix, "a.csv", seds(*OLD))
    rebuild(spark, base, "seds")
    land(base, "landing", "b.csv", seds(("bad", "UT", "TETCB", 7), (2022, "UT", "TETCB", 8)))
    picked(spark, base, "seds")
    done = maintain(spark, base, "seds", f"{base}/picked")
    assert done.touched == ["2022", "none"]
    land(f"{base}/o", SOURCES["seds"].raw_prefix, "a.csv", seds(*OLD, ("bad", "UT", "TETCB", 7), (2022, "UT", "TETCB", 8)))
    rebuild(spark, f"{base}/o", "seds")
    for name in tables_of("seds"):
        assert contents(spark, table_path(base, name)) == contents(spark, table_path(f"{base}/o", name)), name


def test_a_run_that_fails_is_repeated(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    land(base, SOURCES["seds"].raw_prefix, "a.csv", seds(*OLD))
    rebuild(spark, base, "seds")
    land(base, "landing", "b.csv", seds((2023, "UT", "TETCB", 7)))
    picked(spark, base, "seds")
    commit = snapshots.commit

    def failing(spark_, path, *args, **kwargs):
        if "/clean/" in path:
            raise RuntimeError("driver lost")
        return commit(spark_, path, *args, **kwargs)

    monkeypatch.setattr(snapshots, "commit", failing)
    with pytest.raises(RuntimeError, match="driver lost"):
        maintain(spark, base, "seds", f"{base}/picked")
    monkeypatch.setattr(snapshots, "commit", commit)
    assert maintain(spark, base, "seds", f"{base}/picked").touched == ["2023"]
    found = read_table(spark, table_path(base, "seds_state_pct_us")).where(F.col("year") == 2023)
    assert [r["total_btu"] for r in found.collect()] == [7.0]
