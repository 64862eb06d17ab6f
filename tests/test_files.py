import json
import os
import time

import pytest
from pyspark.sql import functions as F

from wattframe.plans.cleaning import distinct_rows
from wattframe.sources.catalog import (
    SOURCES,
    TABLES,
    SourceSpec,
    TableSpec,
    list_tables,
    tables_by_category,
)
from wattframe.sources.files import (
    csv_layouts,
    list_files,
    newest_extract,
    raw_folder,
    read_csv,
    read_pages,
    read_table,
    write_csv,
    write_table,
)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


@pytest.fixture
def raw_root(tmp_path):
    root = tmp_path / "raw files" / "x" / "monthly"
    put(root / "x_2025-01_to_2025-02.csv", "period,value,area-name\n2025-01,1,a\n2025-02,2,\n")
    put(root / "x%20other.csv", 'value,period,area-name\n3,2025-03,"say ""hi"", all"\n')
    put(root / "deep" / "multi.csv", 'period,value,area-name,more\n2025-04,4,"two\nlines",m\n')
    put(root / "incremental" / "x_2025-05.csv", "period,value,area-name\n2025-05,5,e\n")
    put(root / "notes.txt", "period\n")
    return str(root)


def test_columns_are_matched_by_name(spark, raw_root):
    found = read_csv(spark, raw_root)
    assert rows(found, "period", "value", "area-name", "more") == [
        ("2025-01", "1", "a", None), ("2025-02", "2", None, None),
        ("2025-03", "3", 'say "hi", all', None), ("2025-04", "4", "two\nlines", "m"),
    ]


def test_only_files_with_embedded_newlines_are_read_whole(spark, raw_root):
    paths = [r["path"] for r in list_files(spark, raw_root).collect()]
    layouts = csv_layouts(spark, paths)
    assert {spans: len(files) for (header, spans), files in layouts.items() if "more" in header} == {True: 1}
    assert all(not spans for header, spans in layouts if "more" not in header)


def test_incremental_files_are_skipped_unless_asked_for(spark, raw_root):
    periods = rows(read_csv(spark, raw_root, include_incremental=True), "period")
    assert ("2025-05",) in periods and len(periods) == 5
    with pytest.raises(FileNotFoundError):
        read_csv(spark, raw_root + "/incremental")


def test_newest_file_and_load_time(spark, raw_root):
    os.utime(raw_root + "/x%20other.csv", (time.time() + 100,) * 2)
    assert newest_extract(list_files(spark, raw_root)).first()["path"].endswith("other.csv")
    newest = read_csv(spark, raw_root, newest_only=True, loaded_at=True)
    assert rows(newest, "period") == [("2025-03",)]
    assert newest.schema["loaded_at"].dataType.typeName() == "timestamp"


def test_newest_extract_may_be_incremental_or_a_folder_of_parts(spark, raw_root):
    os.utime(raw_root + "/incremental/x_2025-05.csv", (time.time() + 100,) * 2)
    assert rows(read_csv(spark, raw_root, newest_only=True), "period") == [("2025-05",)]
    extract = spark.createDataFrame([(f"2026-{m:02d}", "1") for m in range(1, 13)], "period string, value string")
    write_csv(extract.repartition(3), raw_root + "/x_2026-01_to_2026-12")
    for name in os.listdir(raw_root + "/x_2026-01_to_2026-12"):
        os.utime(f"{raw_root}/x_2026-01_to_2026-12/{name}", (time.time() + 200,) * 2)
    assert read_csv(spark, raw_root, newest_only=True).count() == 12


def test_declared_header_and_records_that_span_lines(spark, raw_root, tmp_path):
    put(tmp_path / "y" / "a.csv", 'period,value\n2025-01,"1\n2"\n2025-02,3\n')
    put(tmp_path / "y" / "incremental" / "b.csv", "period,value\n2025-03,4\n")
    root = str(tmp_path / "y")
    assert rows(read_csv(spark, root, ["period", "value"]), "value") == [("1\n2",), ("3",)]
    every = read_csv(spark, root, ["period", "value"], include_incremental=True, loaded_at=True)
    assert every.count() == 3 and "loaded_at" in every.columns


def test_a_stray_quote_does_not_keep_a_file_whole(spark, tmp_path):
    put(tmp_path / "a.csv", 'period,value,more\n2025-01,5" pipe,"x, ""y"""\n2025-02,2,"",\n')
    layouts = csv_layouts(spark, [str(tmp_path / "a.csv")])
    assert [spans for _, spans in layouts] == [False]
    assert rows(read_csv(spark, str(tmp_path)), "value") == [("2",), ('5" pipe',)]


def test_declared_header_is_checked(spark, tmp_path):
    put(tmp_path / "a.csv", "period,value\n2025-01,1\n")
    assert rows(read_csv(spark, str(tmp_path), ["period", "value"]), "value") == [("1",)]
    put(tmp_path / "b.csv", "value,period\n2,2025-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), ["period", "value"]).collect()


def test_doubled_extract_with_repeated_header(spark, tmp_path):
    lines = ["period,average-price,quantity", "2025-01,203.55,770622", "2025-02,202.25,750997"]
    put(tmp_path / "d.csv", "\n".join(lines * 2) + "\n")
    found = distinct_rows(read_csv(spark, str(tmp_path)))
    assert found.count() == 3  # two data rows and the repeated header
    assert found.where(found["quantity"].try_cast("double").isNotNull()).count() == 2


def test_a_file_without_header_is_an_error(spark, tmp_path):
    put(tmp_path / "a" / "a.csv", 'a,b\n"x\n",2\n')
    put(tmp_path / "b" / "b.csv", "a,b\n1,a long period\n")
    for folder in ("a", "b"):
        with pytest.raises(ValueError, match="header"):
            read_csv(spark, str(tmp_path / folder))


def test_empty_files_count_for_nothing(spark, tmp_path):
    put(tmp_path / "empty.csv", "")
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path))
    put(tmp_path / "a.csv", "period,value\n2025-01,1\n")
    put(tmp_path / "header only.csv", "value,period\n")
    assert rows(read_csv(spark, str(tmp_path)), "period", "value") == [("2025-01", "1")]


def test_pages(spark, tmp_path):
    page = {"response": {"total": "3", "data": [
        {"period": "2025-01", "value": 1}, {"period": "2025-02", "value": "2", "extra": "x"}]}}
    put(tmp_path / "p" / "0.json", json.dumps(page, indent=1))
    put(tmp_path / "p" / "1.json", json.dumps({"response": {"total": "3", "data": [{"period": "2025-03"}]}}))
    put(tmp_path / "p" / "2.json", json.dumps({"response": {"total": "3", "data": []}}))
    found = read_pages(spark, str(tmp_path / "p"))
    assert found.columns == ["period", "value"]
    assert rows(found, "period", "value") == [("2025-01", "1"), ("2025-02", "2"), ("2025-03", None)]
    chosen = read_pages(spark, str(tmp_path / "p"), ["extra"])
    assert rows(chosen, "extra") == [("x",), (None,), (None,)] or len(chosen.collect()) == 3
    put(tmp_path / "lines" / "a.json", "\n".join([json.dumps(page)] * 3))
    assert read_pages(spark, str(tmp_path / "lines"), one_per_line=True).count() == 6
    put(tmp_path / "none" / "2.json", json.dumps({"response": {"total": "0", "data": []}}))
    with pytest.raises(FileNotFoundError):
        read_pages(spark, str(tmp_path / "none"))


def test_raw_folder_names():
    source = SOURCES["coal"]
    assert raw_folder("/b/", source, "2024", "2025") == "/b/raw/coal/annual/coal_2024_to_2025"
    assert raw_folder("/b", source, None, None) == "/b/raw/coal/annual/coal_all_to_all"
    assert (
        raw_folder("/b", source, "2024", "2025", "20260401", incremental=True)
        == "/b/raw/coal/annual/incremental/coal_2024_to_2025_20260401"
    )


def test_csv_round_trip_keeps_text(spark, tmp_path):
    texts = ['quote " and, comma', " padded ", "two\nlines", None, "plain"]
    frame = spark.createDataFrame([(str(n), t) for n, t in enumerate(texts)], "period string, t string")
    write_csv(frame, str(tmp_path / "out"))
    assert rows(read_csv(spark, str(tmp_path / "out")), "period", "t") == rows(frame, "period", "t")


def test_table_sink_sorts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(1000).selectExpr("id % 7 AS year", "id AS v").repartition(5)
    write_table(frame, path, sort=("year", "-v"))
    write_table(frame, path, sort=("year", "-v"))
    stored = read_table(spark, path)
    assert rows(stored, "year", "v") == rows(frame, "year", "v")
    parts = stored.selectExpr("input_file_name() AS f", "year", "v").collect()
    by_file = {}
    for row in parts:
        by_file.setdefault(row["f"], []).append((row["year"], -row["v"]))
    assert all(part == sorted(part) for part in by_file.values())
    one_key = spark.range(20000).selectExpr("1 AS year", "id AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_table(one_key, str(tmp_path / "one"), sort=("year",))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = read_table(spark, str(tmp_path / "one")).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 1 and max(row["count"] for row in sizes) < 15000
    write_table(frame, str(tmp_path / "p"), partition_by=["year"])
    plan = read_table(spark, str(tmp_path / "p")).where("year = 3")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(year" in plan.toString()


def test_catalog(spark):
    assert len(SOURCES) == 14 and len(TABLES) == 19
    assert all(spec.unique_rows and spec.sort for spec in TABLES.values())
    assert len({spec.path for spec in TABLES.values()}) == 19
    # No table lives inside another table's folder.
    paths = [spec.path + "/" for spec in TABLES.values()]
    assert not [a for a in paths for b in paths if a != b and a.startswith(b)]
    groups = tables_by_category()
    assert list(groups) == [
        "Natural Gas", "Crude Oil", "Petroleum", "Coal", "Electricity", "Total Energy", "SEDS"
    ]
    listed = list_tables(spark).groupBy("category").count().collect()
    assert {row["category"]: row["count"] for row in listed}["Electricity"] == 4
    own = TableSpec("mine", "Mine", "mine", "state_name", "v", "V", "MWh", "monthly", "Own")
    assert tables_by_category({**TABLES, "mine": own})["Own"] == ["mine"]
    assert SourceSpec("a", "A", "weekly", ("v",), None, "1 month").raw_prefix == "raw/a/weekly"
