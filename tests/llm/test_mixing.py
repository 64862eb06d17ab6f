import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import AWKWARD
from wattframe.llm.mixing import mixed, probabilities, raked, tempered, words


def cells(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def grid(spark):
    rng = np.random.default_rng(1)
    rows = [
        (f"s{i}", f"l{j}", f"t{k}", int(rng.integers(1, 5000)))
        for i in range(4) for j in range(3) for k in range(2) if (i + j + k) % 7
    ]
    return rows, cells(spark, rows)


def share(frame_rows, spark):
    return spark.createDataFrame(frame_rows, "value string, share double")


def test_raking_against_numpy(spark):
    rows, table = grid(spark)
    goals = {
        "source": {"s0": 1, "s1": 2, "s2": 3, "s3": 4},
        "lang": {"l0": 0.5, "l1": 0.25, "l2": 0.25},
        "topic": {"t0": 30, "t1": 70},
    }
    tables = {n: share([(k, float(v)) for k, v in g.items()], spark) for n, g in goals.items()}
    got = {(r.source, r.lang, r.topic): r.weight for r in raked(table, tables, 60, 1e-7).collect()}
    weight = {r[:3]: float(r[3]) for r in rows}
    total = sum(weight.values())
    for _ in range(200):
        for at, goal in enumerate(goals.values()):
            for value, part in goal.items():
                has = sum(w for k, w in weight.items() if k[at] == value)
                scale = part / sum(goal.values()) * total / has
                weight = {k: w * scale if k[at] == value else w for k, w in weight.items()}
    assert got.keys() == weight.keys()
    for key, value in weight.items():
        assert got[key] == pytest.approx(value, rel=1e-4)


def test_targets_that_say_nothing_or_name_what_is_missing(spark):
    _, table = grid(spark)
    target = share([("s0", 1.0), ("s1", 1.0), ("gone", 5.0), ("s2", None), ("s3", 0.0)], spark)
    found = raked(table, {"source": target}).groupBy("source").agg(F.sum("weight").alias("w"))
    weights = {r.source: r.w for r in found.collect()}
    assert weights["s0"] == pytest.approx(weights["s1"]) and weights["s2"] == weights["s3"] == 0


def test_tempered_and_probabilities(spark):
    _, table = grid(spark)
    even = raked(table, {"lang": tempered(table, "lang", 0.0)})
    sums = [r.w for r in even.groupBy("lang").agg(F.sum("weight").alias("w")).collect()]
    assert sums == pytest.approx([sums[0]] * 3)
    found = probabilities(even, 0.4)
    tokens, expected, most = found.agg(
        F.sum("tokens"), F.sum(F.col("tokens") * F.col("probability")), F.max("probability")
    ).first()
    assert expected == pytest.approx(0.4 * tokens, rel=1e-3) and most <= 1


def test_sample_has_the_target_shares(docs):
    rows = [(i, "a b c d", "en" if i % 4 else "de", f"s{i % 3}") for i in range(6000)]
    table = docs(rows)
    out = mixed(table, {"lang": F.col("lang"), "source": F.col("source")}, words(F.col("text")), {"lang": 0.0, "source": 1.0}, 0.3)
    assert out.columns == [*table.columns, "sampling_weight"]
    found = out.collect()
    assert len(found) == pytest.approx(1800, rel=0.1)
    assert sum(r.lang == "de" for r in found) / len(found) == pytest.approx(0.5, abs=0.05)
    assert sum(r.sampling_weight for r in found) == pytest.approx(6000, rel=0.1)
    assert sorted(out.select("doc_id").collect()) == sorted(r[:1] for r in found)  # the same again


def test_awkward_rows(awkward, nothing):
    for target in ({"lang": 0.5}, {}):
        found = mixed(awkward, {"lang": F.col("lang")}, words(F.col("text")), target, 1.0)
        assert found.count() == len(AWKWARD)
    assert mixed(nothing, {"lang": F.col("lang")}, words(F.col("text")), {"lang": 0.5}).collect() == []


def test_words(spark):
    table = spark.createDataFrame([(None,), ("",), (" \n ",), ("a",), (" a  b\tc\n",)], "text string")
    assert [r[0] for r in table.select(words(F.col("text"))).collect()] == [0, 0, 0, 1, 3]


def test_rare_cells_keep_their_target_shares(spark):
    """The rare language is to be a third: not half of all tokens can stay, but the shares hold."""
    rows = [("s0", "rare", "t", 60), ("s1", "rare", "t", 40), ("s0", "often", "t", 5000), ("s1", "often", "t", 4900)]
    table = cells(spark, rows)
    goals = {"lang": share([("rare", 1.0), ("often", 2.0)], spark), "source": share([("s0", 3.0), ("s1", 1.0)], spark)}
    found = probabilities(raked(table, goals, 60, 1e-7), 0.5).collect()
    kept = {(r.lang, r.source): r.tokens * r.probability for r in found}
    total = sum(kept.values())
    assert sum(v for k, v in kept.items() if k[0] == "rare") / total == pytest.approx(1 / 3, rel=1e-4)
    assert sum(v for k, v in kept.items() if k[1] == "s0") / total == pytest.approx(3 / 4, rel=1e-4)
    assert max(r.probability for r in found) == pytest.approx(1.0)  # as much as the targets let
