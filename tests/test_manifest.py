import os

import pytest

from wattframe.plans.ingest import missing_ranges
from wattframe.functions.calendar import ANNUAL, MONTHLY
from wattframe.plans.refresh import manifest_path, refresh, table_path
from wattframe.sources import snapshots
from wattframe.sources.catalog import SOURCES
from wattframe.sources.files import read_csv, read_table
from wattframe.sources.manifest import latest_known_period, read_known, read_manifest, update_manifest


def put(path, text, at=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if at is not None:
        os.utime(path, (at, at))


def rows(frame):
    return sorted((repr(sorted(r.asDict().items())) for r in frame.collect()))


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "raw"
    put(root / "a b.csv", 'period,area,value\n2023-01,X,1\nperiod,area,value\n2023-12,"two\nlines",2\n', 1000)
    put(root / "c.csv", 'value,"period"\n5,2024-02\n6,\n', 1000)
    put(root / "deep" / "d.csv", "period,value\n2024-11,7\n2025-03,8\nbad,9\n", 1000)
    put(root / "incremental" / "e.csv", "period,value\n2025-06,10\n", 3000)
    put(root / "empty.csv", "", 1000)
    return root


def test_rows_are_those_of_the_full_pass(spark, landed, tmp_path):
    stored = str(tmp_path / "m")
    assert len(update_manifest(spark, str(landed), stored)) == 4
    assert rows(read_known(spark, stored)) == rows(read_csv(spark, str(landed)))
    newest = read_known(spark, stored, newest_only=True)
    assert rows(newest) == rows(read_csv(spark, str(landed), newest_only=True))
    assert latest_known_period(spark, stored) == "2025-06"
    known = {r.path.rsplit("/", 1)[1]: (r.first_period, r.last_period, r.records) for r in read_manifest(spark, stored).collect()}
    assert known["d.csv"] == ("2024-11", "2025-03", 3) and "empty.csv" not in known


def test_known_files_are_not_read_again(spark, landed, tmp_path):
    stored = str(tmp_path / "m")
    update_manifest(spark, str(landed), stored)
    number = snapshots.current(spark, stored).number
    # Other text of the same length and time: only who reads it again can see that.
    changed = (landed / "c.csv").read_text().replace("2024", "1999")
    put(landed / "c.csv", changed, 1000)
    assert update_manifest(spark, str(landed), stored) == []
    assert snapshots.current(spark, stored).number == number
    put(landed / "new.csv", "period,value\n2026-01,1\n")
    assert [p.rsplit("/", 1)[1] for p in update_manifest(spark, str(landed), stored)] == ["new.csv"]
    periods = {r.path.rsplit("/", 1)[1]: r.first_period for r in read_manifest(spark, stored).collect()}
    assert (periods["c.csv"], periods["new.csv"]) == ("2024-02", "2026-01")


def test_only_files_in_range_are_opened(spark, landed, tmp_path):
    stored = str(tmp_path / "m")
    update_manifest(spark, str(landed), stored)

    def opened(*bounds):
        return sorted(p.rsplit("/", 1)[1].replace("%20", " ") for p in read_known(spark, stored, *bounds).inputFiles())

    assert opened("2025") == ["d.csv"]
    assert opened("2024-01", "2024-12") == ["c.csv", "d.csv"]
    assert opened(None, "2023") == ["a b.csv"]
    with pytest.raises(FileNotFoundError):
        opened("2030", "2031")


def test_changed_and_missing_files(spark, landed, tmp_path):
    stored = str(tmp_path / "m")
    update_manifest(spark, str(landed), stored)
    put(landed / "c.csv", "period,value,more\n2020-01,1,m\n", 2000)
    os.remove(landed / "deep" / "d.csv")
    assert len(update_manifest(spark, str(landed), stored)) == 1
    assert rows(read_known(spark, stored)) == rows(read_csv(spark, str(landed)))
    os.remove(landed / "c.csv")
    assert update_manifest(spark, str(landed), stored) == []
    assert rows(read_known(spark, stored)) == rows(read_csv(spark, str(landed)))


def test_refresh_with_a_manifest(spark, tmp_path):
    head = "period,duoarea,area-name,process,value\n"
    folder = tmp_path / SOURCES["natural_gas"].raw_prefix
    for year in (2023, 2024, 2025):
        put(folder / f"{year}.csv", head + "".join(f"{year}-{m:02d},STX,TEXAS,VGM,{m}\n" for m in range(1, 13)))
    base, out = str(tmp_path), str(tmp_path / "out")
    refresh(spark, base, ["natural_gas"], manifest=True)
    assert read_table(spark, table_path(base, "ng_production")).count() == 36
    number = snapshots.current(spark, manifest_path(base, "natural_gas")).number
    refresh(spark, base, ["natural_gas"], start="2024-03", end="2024-05", out=out, manifest=True)
    found = read_table(spark, table_path(out, "ng_production")).collect()
    assert sorted(r["production_mmcf"] for r in found) == [3.0, 4.0, 5.0]
    assert snapshots.current(spark, manifest_path(base, "natural_gas")).number == number


@pytest.mark.parametrize(
    "stored, start, end, grain, expected",
    [
        ([], "2024-11", "2025-02", MONTHLY, [("2024-11", "2025-02", 4)]),
        (["2024-12", "2024-12", " 2025-01"], "2024-11", "2025-02", MONTHLY, [("2024-11", "2024-11", 1), ("2025-02", "2025-02", 1)]),
        (["2020", "2023", "2024", "1900", "x", None], "2019", "2025", ANNUAL, [("2019", "2019", 1), ("2021", "2022", 2), ("2025", "2025", 1)]),
        (["2020"], "2020", "2020", ANNUAL, []),
    ],
)
def test_missing_ranges(spark, stored, start, end, grain, expected):
    frame = spark.createDataFrame([(p,) for p in stored], "period string")
    assert sorted(map(tuple, missing_ranges(frame, start, end, grain).collect())) == expected
