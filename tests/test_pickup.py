import os

from pyspark.sql import functions as F

from wattframe.operators.rows import latest_revision
from wattframe.plans.cleaning import natural_gas
from wattframe.streaming.pickup import (
    append_new_rows,
    newest_delivery,
    pick_up,
    read_picked_up,
    stored_rows,
)

COLUMNS = ["period", "duoarea", "area-name", "process", "value"]
HEADER = ",".join(COLUMNS) + "\n"


def land(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(HEADER + "".join(line + "\n" for line in lines))


def test_new_files_are_picked_up_once(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")

    def run(state="state"):
        pick_up(
            spark, str(landing), COLUMNS, natural_gas, table, str(tmp_path / state), max_files=1
        ).awaitTermination()
        return sorted(tuple(r) for r in read_picked_up(spark, table).select("duoarea", "production_mmcf").collect())

    land(landing, "a.csv", "2025-01,STX,Texas,VGM,1", "2025-01,STX,Texas,VGM,1", HEADER.strip())
    assert run() == [("STX", 1.0)]
    assert run() == [("STX", 1.0)]  # nothing new
    land(landing / "deep", "b.csv", "2025-01,STX,Texas,VGM,1", "2025-01,STX,Texas,VGM,2",
         "2024-12,SOH,Ohio,VGM,3", "2025-13,SOH,Ohio,VGM,4")
    land(landing, "c.csv", "2025-13,SOH,Ohio,VGM,4", "2024-12,SOH,Ohio,VGM,3")
    expected = [("SOH", 3.0), ("SOH", 4.0), ("STX", 1.0), ("STX", 2.0)]
    assert run() == expected
    # A lost checkpoint reads everything again under another query id and adds nothing.
    assert run("other state") == expected
    batch = natural_gas(spark.read.csv(str(landing), header=True, recursiveFileLookup=True))
    picked = read_picked_up(spark, table)
    assert picked.exceptAll(batch).isEmpty() and batch.exceptAll(picked).isEmpty()


def test_records_that_span_lines_arrive_whole(spark, tmp_path):
    land(tmp_path / "landing", "a.csv", '2025-01,STX,"Tex\nas",VGM,1', "2025-01,SOH,Ohio,VGM,2", '2025-02,STX,"5"" pipe",VGM,3')
    table = str(tmp_path / "table")
    pick_up(spark, str(tmp_path / "landing"), COLUMNS, natural_gas, table, str(tmp_path / "s")).awaitTermination()
    found = read_picked_up(spark, table).select("state_name", "production_mmcf").collect()
    assert sorted(map(tuple, found)) == [("5\" pipe", 3.0), ("Ohio", 2.0), ("Tex\nas", 1.0)]


def test_newest_file_wins_within_one_run(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    land(landing, "b.csv", "2025-01,STX,Texas,VGM,9")
    land(landing, "a.csv", "2025-01,STX,Texas,VGM,5")
    os.utime(landing / "b.csv", (1_700_000_000,) * 2)
    pick_up(
        spark, str(landing), COLUMNS, natural_gas, table, str(tmp_path / "s"), every_delivery=True
    ).awaitTermination()
    rows = read_picked_up(spark, table, picked_at=True)
    latest = latest_revision(rows, ["period", "duoarea"], newest_delivery(rows))
    assert [r["production_mmcf"] for r in latest.collect()] == [5.0]
    assert read_picked_up(spark, table).columns == ["period", "duoarea", "state_name", "production_mmcf"]


def test_a_repeated_batch_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored_rows(spark, path) is None
    first = spark.createDataFrame([(2024, "a"), (None, "n")], "year int, v string")
    second = spark.createDataFrame([(2024, "a"), (2024, "b"), (2025, "c"), (None, "n")], "year int, v string")
    append_new_rows(first, path, "q-0")
    for _ in range(2):
        append_new_rows(second, path, "q-1")
        found = sorted((tuple(r) for r in read_picked_up(spark, path).collect()), key=repr)
        assert found == [(2024, "a"), (2024, "b"), (2025, "c"), (None, "n")]


def test_latest_revision_of_every_delivery(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, value in enumerate(["first", "second", "first"]):
        delivered = spark.createDataFrame([(2024, "k", value)] * 2, "year int, key string, v string")
        append_new_rows(delivered, path, f"q-{batch}", every_delivery=True)
    rows = read_picked_up(spark, path, picked_at=True)
    assert rows.count() == 3
    latest = latest_revision(rows, ["year", "key"], [F.desc("picked_at")])
    assert [row["v"] for row in latest.collect()] == ["first"]
    assert read_picked_up(spark, path).columns == ["year", "key", "v"]


def test_batches_are_compared_by_digests_alone(spark, tmp_path, monkeypatch):
    from wattframe.streaming import pickup

    path = str(tmp_path / "t")
    schema = "year int, key string, v double"
    rows = [(2024, "a", 0.0), (2024, "", None), (2024, None, None), (2024, "a", float("nan")), (None, "u", 1.0)]
    append_new_rows(spark.createDataFrame(rows, schema), path, "q-0")
    again = [(2024, "a", -0.0), (2024, "", None), (2024, None, None), (2024, "a", float("nan")), (None, "u", 1.0)]
    read = []
    stored = pickup.stored_rows
    monkeypatch.setattr(pickup, "stored_rows", lambda *a: read.append(stored(*a)) or read[-1])
    append_new_rows(spark.createDataFrame([*again, (2024, "a", 2.0), (2025, "a", 0.0)], schema), path, "q-1")
    (table,) = read
    assert pickup.DIGEST in table.columns
    found = read_picked_up(spark, path)
    assert found.columns == ["year", "key", "v"]
    assert found.count() == 7
    assert found.where("v = 2.0 OR year = 2025").count() == 2


def test_a_table_from_before_digests(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(2024, "a"), (2024, "b")], "year int, v string")
    old.withColumn("period_year", F.col("year")).write.partitionBy("period_year").parquet(f"{path}/batch_id=q-0")
    for batch, values in (("q-1", "ac"), ("q-2", "bcd")):
        rows = [(2024, v) for v in values]
        append_new_rows(spark.createDataFrame(rows, "year int, v string"), path, batch)
    assert sorted(map(tuple, read_picked_up(spark, path).select("v").collect())) == [("a",), ("b",), ("c",), ("d",)]
