"""Plans that matter at scale: one scan of the facts, no sort below an aggregate, pushed filters,
no shuffle of rows for a row-level share, group limits before the shuffle."""

import re
import pytest
from pyspark.sql import functions as F

from wattframe.operators.ranking import top_n_per
from wattframe.operators.rows import latest_revision
from wattframe.operators.shares import group_share, row_share
from wattframe.plans import tables
from wattframe.plans.cleaning import CLEANING
from wattframe.sources.files import read_table, text_schema, write_table


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "facts")
    facts = spark.range(5000).selectExpr(
        "id", "id % 11 AS year", "concat('s', id % 3) AS state", "concat('f', id % 5) AS fuel",
        "CAST(id % 97 AS DOUBLE) AS v", "'unused' AS text",
    )
    write_table(facts, path)
    return read_table(spark, path)


def test_group_share_scans_the_facts_once(stored):
    groups = stored.groupBy("year", "state", "fuel").agg(F.sum("v").alias("v"))
    plan = final_plan(group_share(groups, "v", ["year", "fuel"], total="t", share="p"))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert "ReadSchema: struct<year:bigint,state:string,fuel:string,v:double>" in plan
    member = group_share(
        groups, "v", ["year"], total="t", share="p", member=F.col("fuel") == "f1"
    )
    assert final_plan(member).count("FileScan") == 1


def test_a_total_is_repeated_by_the_rows_of_its_key(stored, monkeypatch):
    """The list of large keys reads the totals' own exchange: one scan, and no total 16 times."""
    from wattframe.operators import shares

    groups = stored.groupBy("year", "state", "fuel").agg(F.sum("v").alias("v"))
    for bound in (shares.SLICE_ROWS, 2):
        monkeypatch.setattr(shares, "SLICE_ROWS", bound)
        plan = final_plan(group_share(groups, "v", ["year", "fuel"], total="t", share="p"))
        assert plan.count("FileScan") == 1 and "CEIL" in plan and "sequence(0, 15" not in plan


def test_row_share_does_not_move_the_rows(stored):
    plan = final_plan(row_share(stored, "v", ["year"], total="t", share="p"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_group_limits_before_the_shuffle(stored):
    groups = stored.groupBy("state", "id").agg(F.sum("v").alias("v"))
    assert final_plan(top_n_per(groups, ["state"], "v", 3, ["id"])).count("WindowGroupLimit") >= 2
    assert final_plan(latest_revision(stored, ["state"], [F.desc("id")])).count("WindowGroupLimit") >= 2


def test_groups_are_cut_before_they_meet_for_any_length(spark, stored):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    try:
        for frame in (
            top_n_per(stored.select("state", "id", "v"), ["state"], "v", 5000, ["id"]),
            latest_revision(stored, ["state"], [F.desc("id")]),
        ):
            plan = final_plan(frame)
            assert plan.count("Window [") >= 2 and "hashpartitioning(state, _slice" in re.sub(r"#\d+L?", "", plan)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_named_pivot_is_one_shuffle(stored):
    wide = tables.pivot_named(stored, ["year"], "fuel", "v", {"f1": "one", "f2": "two"})
    plan = final_plan(wide)
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
    assert "In(fuel, [f1,f2])" in plan


def test_filters_of_a_cleaning_step_reach_the_scan(spark, tmp_path):
    columns = ["period", "duoarea", "area-name", "process", "value", "unused"]
    path = str(tmp_path / "raw")
    spark.createDataFrame([("2025-01", "STX", "t", "VGM", "1", "x")], text_schema(columns)).write.parquet(path)
    plan = final_plan(CLEANING["natural_gas"](read_table(spark, path)))
    assert "StringStartsWith(duoarea,S)" in plan and "EqualTo(process,VGM)" in plan
    assert "unused" not in plan


def test_nothing_is_sorted_below_an_aggregate(spark, tmp_path):
    columns = ["period", "stateId", "stateDescription", "seriesId", "seriesDescription", "value", "unit"]
    path = str(tmp_path / "raw")
    rows = [(str(2000 + n), "TX", "Texas", "TETCB", "d", str(n), "u") for n in range(20)]
    spark.createDataFrame(rows, text_schema(columns)).write.parquet(path)
    clean = CLEANING["seds"](read_table(spark, path))
    plan = final_plan(tables.state_fuel_shares(clean))
    assert "rangepartitioning" not in plan and "Sort [" not in plan


def test_no_python_workers_anywhere(stored):
    groups = stored.groupBy("year", "state").agg(F.sum("v").alias("v"))
    plan = final_plan(group_share(groups, "v", ["year"], total="t", share="p"))
    assert "Python" not in plan and "Arrow" not in plan


def test_a_hot_key_is_cut_by_adaptive_execution(spark, monkeypatch):
    """A plain join to an aggregate is never split; the sliced join is, even with one slice."""
    from wattframe.operators import shares

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        monkeypatch.setattr(shares, "SLICES", 1)
        rows = spark.range(0, 400_000, 1, 8).selectExpr(
            "id", "IF(id % 3 = 0, -1, id % 1009) AS key", "id % 7 AS v", "concat('text ', id) AS t"
        )
        totals = rows.groupBy("key").agg(F.sum("v").alias("total"))
        joined = shares.join_totals_sliced(rows, totals, ["key"])
        summed = joined.agg(F.count("*"), F.sum("total"), F.max("t"))
        assert "SortMergeJoin(skew=true)" in final_plan(summed)
        plain = rows.join(totals, "key", "left").agg(F.count("*"), F.sum("total"), F.max("t"))
        assert "skew=true" not in final_plan(plain)
        assert summed.first() == plain.first()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
