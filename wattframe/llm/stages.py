"""The stages of the document pipeline: each takes all documents that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm import language
from wattframe.llm.line_dedup import without_common_lines
from wattframe.llm.ngram_join import BROADCAST_ROWS, linked_components
from wattframe.llm.packing import packed
from wattframe.llm.queries import TOKENIZER, balanced, language_model
from wattframe.session import keep

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near-duplicates: five words, a similarity of 0.8 or more.
SHINGLE_WORDS, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; what no centroid is near enough to goes.

    NULL and empty texts have no language and go. Repeated rows are judged alike; no rows in, no rows
    out; other columns than those of documents are ignored.
    """
    return language.keep_determined(docs.select(*COLUMNS), language_model(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the blocks that an earlier document has; a document left empty by that goes.

    NULL and empty texts stay as they are, with their ``n_chars``; repeated rows get the same text.
    """
    left = without_common_lines(docs.select(*COLUMNS))
    gone = (F.col("lines_deleted") > 0) & (F.col("text") == "")
    changed = F.when(F.col("lines_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.where(~gone).withColumn("n_chars", changed).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram links connect: the one with the smallest identifier.

    If several texts of a group have that identifier, the one with the smallest hash stays; of rows that
    repeat identifier and text one stays, the smallest by its other columns (NULL first). An identifier's
    texts that no link connects all stay. Documents without identifier or without words are linked
    with nothing and stay.
    """
    docs = docs.select(*COLUMNS)
    found = keep(linked_components(docs, SHINGLE_WORDS, PERCENT, by_text=True).where("component IS NOT NULL"))
    heads = found.where("component_id = doc_id").groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = heads.groupBy("component").agg(F.min("text_hash").alias("stays"), F.max("text_hash").alias("last"))
    others = heads.join(first.where("stays < last"), "component").where("text_hash != stays")
    later = found.where("component_id < doc_id").select("doc_id", "text_hash").distinct()
    copies = keep(later.unionByName(others.select("doc_id", "text_hash")))
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    left = docs.withColumn("text_hash", text_hash).join(copies, ["doc_id", "text_hash"], "left_anti")
    repeated = keep(heads.where("n > 1").select("doc_id", "text_hash"))
    if (number := repeated.count()) == 0:
        return left.select(*COLUMNS)
    if number <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    once = left.join(repeated, ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)
    again = left.join(repeated, ["doc_id", "text_hash"], "left_semi").groupBy("doc_id", "text_hash")
    return once.unionByName(again.agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have their target weights.

    NULL and empty texts carry no tokens; repeated rows are drawn alike; no rows in, no rows out.
    """
    return balanced(docs.select(*COLUMNS)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, one row per piece of a document; a NULL or empty text is its end sign."""
    return packed(docs, TOKENIZER)
