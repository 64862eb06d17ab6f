"""Distinct counts by bitmaps against plain sets: levels, later periods, NULLs, several buckets."""

import pytest
from pyspark.sql import functions as F

from wattframe.operators.distincts import (
    distinct_bitmaps,
    distinct_counts,
    member_numbers,
    merge_bitmaps,
    stored_bitmaps,
)


@pytest.fixture(scope="module")
def rows(spark):
    """80,000 members, one of them in a third of the rows; places without any, NULL places."""
    return spark.range(120_000).selectExpr(
        "CAST(2020 + id % 4 AS INT) AS year",
        "CASE WHEN id % 10 = 0 THEN NULL ELSE concat('p', id % 7) END AS place",
        "CASE WHEN id % 7 = 6 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE concat('m', id * 7919 % 90000) END AS member",
    )


def sets(rows, keys):
    found = {}
    for r in rows.collect():
        members = found.setdefault(tuple(r[k] for k in keys), set())
        if r["member"] is not None:
            members.add(r["member"])
    return {key: len(members) for key, members in found.items()}


def counts(bitmaps, keys):
    return {tuple(r)[:-1]: r["n"] for r in distinct_counts(bitmaps, keys, "n").collect()}


def test_every_level_comes_from_the_finest(rows):
    stored = stored_bitmaps(rows, ["year", "place"], "member")
    assert stored.select("bucket").distinct().where("bucket IS NOT NULL").count() > 1
    for keys in (["year", "place"], ["year"], ["place"], []):
        assert counts(stored, keys) == sets(rows, keys)


def test_later_periods_add_up(rows):
    early, late = rows.where("year < 2022"), rows.where("year >= 2022")
    numbers = member_numbers(early, "member")
    more = member_numbers(late, "member", numbers)
    both = more.join(numbers.withColumnRenamed("number", "before"), "member")
    assert both.where("number != before").isEmpty() and both.count() == numbers.count()
    found = more.agg(F.count("*"), F.countDistinct("number"), F.min("number"), F.max("number")).first()
    assert found[0] == found[1] == found[3] and found[2] == 1
    parts = distinct_bitmaps(early, ["year", "place"], "member", numbers).unionByName(
        distinct_bitmaps(late, ["year", "place"], "member", more)
    )
    assert counts(merge_bitmaps(parts, ["place"]), ["place"]) == sets(rows, ["place"])


def test_no_rows(rows):
    stored = stored_bitmaps(rows.limit(0), ["place"], "member")
    assert counts(stored, ["place"]) == {} and distinct_counts(stored, [], "n").collect()[0]["n"] == 0
