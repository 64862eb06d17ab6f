"""Exact distinct counts that add up: bitmaps of numbered members, stored once, merged for any level.

A count of distinct members cannot be summed over years or places; the set can be united. Members get
dense numbers, and a bitmap holds the numbers of one range of 32,768 (4 KB, whatever it holds). So
coarser levels and later periods read the stored bitmaps and never the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.operators.ranking import rank_all
from wattframe.session import keep


def member_numbers(rows: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``column, number``: every member of the rows with its number from 1; NULL is no member.

    ``known`` is an earlier result: its numbers stay, and members that it lacks follow after
    them, so bitmaps that were stored with it stay right.
    """
    members = rows.where(F.col(column).isNotNull()).select(column).distinct()
    if known is None:
        return rank_all(members, [F.asc(column)], "number")
    new = rank_all(members.join(known, column, "left_anti"), [F.asc(column)], "number")
    largest = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    return known.unionByName(new.withColumn("number", F.col("number") + largest))


def distinct_bitmaps(rows: DataFrame, keys: list[str], column: str, numbers: DataFrame) -> DataFrame:
    """``*keys, bucket, members``: the members of each key as bitmaps, to be stored.

    A member counts once per key before it is numbered, so one that much of the rows name is no hot
    key. Keys without any member keep an empty bitmap.
    """
    pairs = rows.select(*keys, column).distinct()
    numbered = pairs.join(numbers, column, "left")
    return numbered.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members")
    )


def merge_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of a coarser level, or of several periods in one (``unionByName``)."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def distinct_counts(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``*keys, name``: number of distinct members per key, equal to ``count(DISTINCT ...)`` of the rows."""
    merged = merge_bitmaps(bitmaps, keys)
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("members")), F.lit(0)).alias(name))


def stored_bitmaps(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Members numbered and their bitmaps at the finest level, kept for the levels that follow."""
    return keep(distinct_bitmaps(rows, keys, column, keep(member_numbers(rows, column))))
