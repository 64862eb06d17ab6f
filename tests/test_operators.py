"""Generic operators against brute force in Python."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wattframe.operators import shares
from wattframe.operators.changes import change_from_previous, change_in_long_series
from wattframe.operators.pivots import (
    discover_codes,
    sums_by_code,
    pivot_discovered,
    pivot_named,
    pivot_share,
    unpivot_labelled,
)
from wattframe.operators.ranking import rank_all, sum_by, top_n, top_n_per
from wattframe.operators.rows import (
    any_present,
    distinct_rows,
    latest_revision,
    numeric_columns,
    within_range,
)


def tuples(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture
def facts(spark):
    """A third of the rows share one key; some keys are NULL; one group is all zero."""
    pick = random.Random(7)
    rows = []
    for number in range(600):
        key = "hot" if number % 3 == 0 else pick.choice(["a", "b", "c", None])
        rows.append((key, f"m{pick.randrange(40)}", number, Decimal(pick.randrange(1, 9999)) / 100))
    rows += [("zero", "m0", 1000 + n, Decimal("0.00")) for n in range(3)]
    return spark.createDataFrame(rows, "key string, member string, id int, value decimal(18,2)")


def expected_shares(rows):
    totals = defaultdict(Decimal)
    for row in rows:
        if row["key"] is not None:
            totals[row["key"]] += row["value"]
    found = {}
    for row in rows:
        total = totals.get(row["key"])
        share = round(float(row["value"]) / float(total) * 100, 4) if total else None
        found[row["id"]] = (total, share)
    return found


@pytest.mark.parametrize("bound", [shares.MAX_BROADCAST_BYTES, 0])
def test_row_share_with_and_without_broadcast(facts, monkeypatch, bound):
    monkeypatch.setattr(shares, "MAX_BROADCAST_BYTES", bound)
    shared = shares.row_share(facts, "value", ["key"], total="total", share="pct")
    found = {row["id"]: (row["total"], row["pct"]) for row in shared.collect()}
    wanted = expected_shares(facts.collect())
    assert found.keys() == wanted.keys()
    for key, (total, share) in wanted.items():
        assert found[key][0] == total
        assert found[key][1] == pytest.approx(share, abs=1e-4) if share is not None else found[key][1] is None


def test_size_check_measures_bytes(facts):
    kept, size = shares.keep_measured(facts)
    texts = sum(len(row["key"] or "") + len(row["member"]) for row in facts.collect())
    assert kept.count() == facts.count()
    assert size == texts + facts.count() * 4 * shares.FIELD_BYTES
    assert shares.keep_measured(facts.limit(0))[1] == 0


def test_group_shares_sum_to_hundred(facts):
    groups = facts.groupBy("key", "member").agg(F.sum("value").alias("value"))
    shared = shares.group_share(groups, "value", ["key"], total="total", share="pct")
    assert shared.count() == groups.count()
    by_key = defaultdict(float)
    for row in shared.collect():
        if row["key"] in (None, "zero"):
            assert row["pct"] is None
        else:
            by_key[row["key"]] += row["pct"]
    assert all(total == pytest.approx(100, abs=0.01) for total in by_key.values())
    assert by_key.keys() == {"hot", "a", "b", "c"}


def test_group_share_of_a_member(facts):
    groups = facts.groupBy("key", "member").agg(F.sum("value").alias("value"))
    shared = shares.group_share(
        groups, "value", ["key"], total="total", share="pct", member=F.col("member") == "m1"
    )
    members = {r["key"]: r["value"] for r in groups.where("member = 'm1'").collect()}
    for row in shared.collect():
        assert row["total"] == (members.get(row["key"]) if row["key"] else None)


def test_totals_next_to_rows_of_keys_only(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    totals = spark.createDataFrame([("a", 2), (None, 1)], "key string, n int")
    joined = shares.join_totals_sliced(rows, totals, ["key"])
    assert tuples(joined) == [("a", 2), ("a", 2), (None, None)]


def test_share_has_the_same_columns_on_both_ways(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a", 2.0), (2, "a", 6.0), (3, None, 1.0)], "id int, k string, v double")
    found = []
    for bound in (shares.MAX_BROADCAST_BYTES, -1):
        monkeypatch.setattr(shares, "MAX_BROADCAST_BYTES", bound)
        share = shares.row_share(rows, "v", ["k"], total="t", share="p")
        found.append((share.columns, tuples(share)))
    assert found[0] == found[1] and found[0][0] == ["id", "k", "v", "t", "p"]


def test_the_session_limits_pivot_columns(spark):
    rows = spark.range(10_001).selectExpr("id % 2 AS year", "concat('c', id) AS code", "id AS v")
    with pytest.raises(ValueError):
        discover_codes(rows, "code")
    spark.conf.set("spark.sql.pivotMaxValues", "20000")
    try:
        assert len(discover_codes(rows, "code")) == 10_001
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    sums = sums_by_code(rows, ["year"], "code", "v", "sums").collect()
    assert sorted(len(r["sums"]) for r in sums) == [5000, 5001]


def test_only_a_sum_of_nothing_is_zero(spark):
    rows = spark.createDataFrame([("a", 2.0), ("b", None)], "place string, v double")
    assert tuples(sum_by(rows, ["place"], "v")) == [("a", 2.0), ("b", 0.0)]
    for agg in (F.avg, F.min, F.max):
        assert tuples(sum_by(rows, ["place"], "v", agg)) == [("a", 2.0), ("b", None)]


def test_pivots(spark):
    rows = spark.createDataFrame(
        [(1, "A", 2.0), (1, "A", 3.0), (1, "B", 4.0), (2, "B", 0.0), (3, "C", 9.0)],
        "year int, code string, v double",
    )
    named = pivot_named(rows, ["year"], "code", "v", {"A": "first", "B": "second"})
    assert tuples(named) == [(1, 5.0, 4.0), (2, None, 0.0)]
    assert discover_codes(rows, "code") == ["A", "B", "C"]
    with pytest.raises(ValueError):
        discover_codes(rows, "code", limit=2)
    found = pivot_discovered(rows, ["year"], "code", "v")
    assert found.columns == ["year", "A", "B", "C"]
    assert tuples(found) == [(1, 5.0, 4.0, None), (2, None, 0.0, None), (3, None, None, 9.0)]
    shared = pivot_share(rows, ["year"], "code", "v", "B")
    assert shared.columns == ["year", "A", "B", "C", "a_pct", "c_pct"]
    assert tuples(shared.select("year", "a_pct", "c_pct")) == [
        (1, 125.0, None), (2, None, None), (3, None, None)
    ]
    assert pivot_share(rows, ["year"], "code", "v", "TE").columns == ["year", "A", "B", "C"]
    long = unpivot_labelled(found, ["year"], {"A": "Aa", "B": "Bb", "C": "Cc"}, "code", "v")
    melted = sum_by(long.where("v IS NOT NULL"), ["year", "code"], "v")
    assert tuples(melted) == tuples(sum_by(rows, ["year", "code"], "v"))


def test_change_counts_the_previous_row(spark):
    rows = spark.createDataFrame(
        [("x", 2020, 10.0), ("x", 2021, 0.0), ("x", 2023, 5.0), ("y", 2021, 1.0)],
        "s string, year int, v double",
    )
    names = {"change": "d", "change_pct": "p"}
    changed = change_from_previous(rows, ["s"], "year", "v", **names)
    assert tuples(changed.select("s", "year", "d", "p")) == [
        ("x", 2020, None, None), ("x", 2021, -10.0, -100.0), ("x", 2023, 5.0, None),
        ("y", 2021, None, None),
    ]
    strict = change_from_previous(rows, ["s"], "year", "v", consecutive_only=True, **names)
    assert tuples(strict.where("year = 2023").select("d")) == [(None,)]


def test_distinct_keeps_revisions_and_latest_takes_one(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, "2025-01-01"), ("a", 1.0, "2025-01-01"), ("a", 2.0, "2025-02-01"),
         ("b", None, "2025-01-01"), ("b", 3.0, "2025-01-01")],
        "key string, v double, loaded_at string",
    )
    assert distinct_rows(rows).count() == 4
    latest = latest_revision(rows, ["key"], [F.desc("loaded_at")])
    assert tuples(latest) == [("a", 2.0, "2025-02-01"), ("b", 3.0, "2025-01-01")]


def test_presence_and_columns(spark):
    rows = spark.createDataFrame(
        [(1, None, None), (2, 1.0, None), (3, None, "x")], "id int, a double, b string"
    )
    assert tuples(rows.where(any_present("a", "b")).select("id")) == [(2,), (3,)]
    assert numeric_columns(rows, skip=("id",)) == ["a"]
    assert tuples(within_range(rows, "id", 2, 2).select("id")) == [(2,)]
    assert within_range(rows, "id").count() == 3


def test_sums_top_lists_and_ranking(spark):
    rows = spark.createDataFrame(
        [("b", 2.0), ("a", 1.0), ("a", 1.0), ("c", None), (None, 50.0), ("d", 9.0)],
        "place string, v double",
    )
    sums = sum_by(rows, ["place"], "v")
    assert tuples(sums) == [("a", 2.0), ("b", 2.0), ("c", 0.0), ("d", 9.0)]
    assert [r["place"] for r in top_n(sums, "v", 2, ["place"]).collect()] == ["d", "a"]
    ranked = rank_all(sums, [F.desc("v"), F.asc("place")])
    assert tuples(ranked.select("position", "place")) == [(1, "d"), (2, "a"), (3, "b"), (4, "c")]


def test_ranking_over_many_partitions(spark):
    pick = random.Random(3)
    data = [(number, pick.randrange(500)) for number in range(5000)]
    rows = spark.createDataFrame(data, "id int, v int").repartition(13)
    ranked = rank_all(rows, [F.desc("v"), F.asc("id")])
    wanted = {
        key: place for place, (key, _) in enumerate(sorted(data, key=lambda p: (-p[1], p[0])), 1)
    }
    assert {row["id"]: row["position"] for row in ranked.collect()} == wanted


def test_top_per_group_with_a_hot_group(spark):
    pick = random.Random(5)
    data = [("hot" if n % 3 else f"g{n % 7}", n, pick.randrange(100)) for n in range(3000)]
    rows = spark.createDataFrame(data, "g string, id int, v int")
    wanted = []
    groups = defaultdict(list)
    for group, key, value in data:
        groups[group].append((-value, key))
    for group, members in groups.items():
        wanted += [
            (group, key, -value, place)
            for place, (value, key) in enumerate(sorted(members)[:4], 1)
        ]
    assert tuples(top_n_per(rows, ["g"], "v", 4, ["id"])) == sorted(wanted, key=repr)


def hot_rows(spark):
    """A third of the rows under one key, a ninth under NULL, the others under many keys."""
    return spark.range(9000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 9 = 1 THEN NULL ELSE concat('k', id % 500) END AS key",
        "CAST(id % 7 AS DOUBLE) AS v",
    )


def test_only_keys_of_many_rows_are_cut(spark, monkeypatch):
    """The total of the hot key is repeated by its rows, all others once; no task gets the key whole."""
    monkeypatch.setattr(shares, "SLICE_ROWS", 500)
    rows = hot_rows(spark)
    totals = rows.groupBy("key").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    wanted = {r["key"]: r["total"] for r in totals.collect()}
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = shares.join_totals_sliced(rows, totals, ["key"], counted="n")
        assert joined.columns == ["id", "key", "v", "total"]
        placed = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert sorted(r["id"] for r in placed) == list(range(9000))
    assert all(r["total"] == (wanted[r["key"]] if r["key"] else None) for r in placed)
    tasks = {}
    for r in placed:
        tasks.setdefault(r["key"], []).append(r["task"])
    assert len(set(tasks["hot"])) >= 4 and len(set(tasks[None])) >= 2
    assert all(len(set(found)) == 1 for key, found in tasks.items() if key not in ("hot", None))


def test_shares_with_large_keys_are_the_same(spark, monkeypatch):
    groups = hot_rows(spark)
    found = []
    for bound in (shares.SLICE_ROWS, 500, 1):
        monkeypatch.setattr(shares, "SLICE_ROWS", bound)
        shared = shares.group_share(groups, "v", ["key"], total="t", share="p")
        found.append((shared.columns, sorted(shared.collect(), key=lambda r: r["id"])))
    assert found[0] == found[1] == found[2] and len(found[0][1]) == 9000


def test_long_series_change_as_short_ones(spark):
    """Series that end, start and go on at partition edges, with NULL keys, times, values and gaps."""
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'long' WHEN id % 50 = 1 THEN NULL ELSE concat('s', id % 40) END AS s",
        "IF(id % 211 = 0, NULL, CAST(id * 7 % 3001 AS INT)) AS t", "IF(id % 17 = 0, NULL, CAST(id % 23 AS DOUBLE)) AS v",
        "CAST(id AS INT) AS n",
    )
    names = {"change": "d", "change_pct": "p", "ties": ("n",)}
    spread = {}
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for strict in (False, True):
            for series in (["s"], []):
                short = change_from_previous(rows, series, "t", "v", consecutive_only=strict, **names)
                long = change_in_long_series(rows, series, "t", "v", consecutive_only=strict, **names)
                assert long.columns == short.columns
                found = long.withColumn("task", F.spark_partition_id()).collect()
                for r in found:
                    spread.setdefault(len(series), set()).add(r["task"])
                assert sorted((r["n"], r["d"], r["p"]) for r in found if r["d"] is not None) == sorted(
                    (r["n"], r["d"], r["p"]) for r in short.collect() if r["d"] is not None
                ) and len(found) == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(spread[0]) > 2 and len(spread[1]) > 2
    nothing = change_in_long_series(rows.limit(0), ["s"], "t", "v", **names)
    assert nothing.collect() == [] and nothing.columns == ["s", "t", "v", "n", "d", "p"]
