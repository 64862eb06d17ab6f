import hashlib
import re

from pyspark.sql import functions as F

from conftest_llm import AWKWARD
from wattframe.llm.exact_dedup import exact_duplicates


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(body, []).append(doc_id)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        smallest = min(known, default=None)
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, smallest, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def result(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in frame.collect()), key=repr)


def test_awkward_rows(awkward):
    found = exact_duplicates(awkward)
    assert result(found) == expected(AWKWARD)
    kept = found.groupBy("text_sha256").agg(F.count_if("kept").alias("kept")).collect()
    assert all(row.kept == 1 for row in kept)


def test_group_over_many_partitions(spark, docs):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = exact_duplicates(docs(rows))
        assert result(found) == expected(rows)
        assert found.where("kept").count() == 201
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nothing(nothing):
    assert exact_duplicates(nothing).collect() == []
