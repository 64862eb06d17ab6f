"""How far the sources of a language differ in their words, from bitmaps of count levels.

Terms of a language get numbers, most frequent first. For each (source, count) a bitset holds the
numbers of the terms that occur so many times in the source; a bitset is stored in words of 64
terms, only where a bit is set, and the terms with count zero are the complement of the others. For
two sources, AND and popcount of two bitsets count the terms of a joint cell (count here, count there),
which all have the same difference of probabilities: the cell's difference times its terms, summed over
all cells, is the sum over all terms. Frequent terms share words with frequent terms and rare with rare,
so a word holds few levels and few cells.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices
from wattframe.operators.ranking import rank_all
from wattframe.operators.rows import first_rows
from wattframe.session import keep

#: A term is kept in a language if so many of its documents have it.
LEAST_DOCUMENTS = 30
#: Ranks of the part ``term``.
TOP_TERMS = 50
#: Added to every count before it becomes a probability, and the unit of probabilities.
PRIOR, UNIT = 5, 1_000_000_000
#: Entries that a task adds up before it passes them on: bounds its memory.
HELD = 400_000

#: Lower-cases A-Z and turns all other ASCII but letters into spaces; what is not ASCII stays.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs``: occurrences and documents, added up within the task."""
    counts: dict[tuple, tuple[Counter, Counter]] = {}

    def passed_on():
        for (lang, source), (occurrences, documents) in counts.items():
            terms = list(occurrences)
            columns = [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()),
                pa.array(list(occurrences.values()), pa.int64()),
                pa.array([documents[term] for term in terms], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        counts.clear()

    for batch in in_slices(batches, 256):
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
            terms = text.translate(_LETTERS).split()
            occurrences, documents = counts.setdefault((lang, source), (Counter(), Counter()))
            occurrences.update(terms)
            documents.update(set(terms))
        if sum(len(occurrences) for occurrences, _ in counts.values()) > HELD:
            yield from passed_on()
    yield from passed_on()


def term_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, lang_n`` of the kept terms with an occurrence in the source.

    ``docs`` has ``lang, source, text`` without NULL. A task sends one row per term and source; rows of
    a term meet by (language, term), where a frequent term has one row per source and task at most.
    """
    counted = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        _counted, "lang string, source string, term binary, n long, docs long"
    )
    cells = (
        counted.repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    term = Window.partitionBy("lang", "term")  # a row per source
    whole = cells.withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term)})
    kept = whole.where(F.col("lang_docs") >= least_documents)
    return kept.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers of any size."""
    above = (count + PRIOR).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + PRIOR * terms.cast("long")).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def bitmaps(numbered: DataFrame) -> DataFrame:
    """``lang, word, source, n, bits`` from ``lang, source, n, number``: 64 terms to a word."""
    bit = F.expr("shiftleft(1L, cast(number % 64 AS int))")
    return numbered.groupBy("lang", F.expr("number div 64").alias("word"), "source", "n").agg(
        F.bit_or(bit).alias("bits")
    )


def with_zeros(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """The levels and, for each group and word, the terms of the word that the group lacks.

    ``groups`` has ``lang, source``. The complement is within the word's terms, that is, the union of
    all sources' bits.
    """
    words = levels.groupBy("lang", "word").agg(F.bit_or("bits").alias("mask"))
    present = levels.groupBy("lang", "word", "source").agg(F.bit_or("bits").alias("present"))
    absent = (
        words.join(groups.select("lang", "source"), "lang")
        .join(present, ["lang", "word", "source"], "left")
        .withColumn("bits", F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("present", F.lit(0).cast("long")))))
        .where("bits != 0")
        .select("lang", "word", "source", F.lit(0).cast("long").alias("n"), "bits")
    )
    return levels.unionByName(absent)


def pair_sums(levels: DataFrame) -> DataFrame:
    """``lang, source, item, value``: per pair of sources the sum over all terms, both ways.

    ``levels`` has ``lang, word, source, p, bits``. Only words meet words; the rows that leave the join are
    the joint cells with a term, at most one per term and pair.
    """
    here = levels.select("lang", "word", "source", F.col("p").alias("p"), F.col("bits").alias("bits"))
    there = levels.select(
        "lang", "word", F.col("source").alias("item"), F.col("p").alias("q"), F.col("bits").alias("other")
    )
    both = F.col("bits").bitwiseAND(F.col("other"))
    cells = here.join(there, ["lang", "word"]).where((F.col("source") < F.col("item")) & (both != 0))
    sums = cells.groupBy("lang", "source", "item").agg(
        F.sum(F.bit_count(both) * F.abs(F.col("p") - F.col("q"))).alias("value")
    )
    sums = keep(sums)
    turned = sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return sums.unionByName(turned)


def source_divergence(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (language, source) that occurs.

    Part ``pair`` has every other source of the language, all ranks; part ``term`` the terms that the
    source has more often than its language, the first ``top_terms``. NULL text, language and source
    are empty, long texts count whole, repeated rows count each, ties are ranked by name (UTF-8). A
    group without terms still has its pairs, with value 0 if its language keeps no term. Other columns
    are ignored, so their names cannot clash; no rows in, no rows out.
    """
    plain = docs.select(
        *[
            F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)
            for column, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        ]
    )
    counts = keep(term_counts(plain, least_documents))
    terms = counts.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    numbered = keep(rank_all(terms, [F.col("lang"), F.desc("lang_n"), F.col("term")], "number"))
    of_lang = numbered.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per source of a language.
    groups = keep(
        plain.select("lang", "source").distinct()
        .join(of_group, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .fillna(0, ["total", "terms", "lang_total"])
    )

    cells = counts.join(numbered.select("lang", "term", "number"), ["lang", "term"])
    levels = keep(bitmaps(cells.select("lang", "source", "n", "number")))
    levels = with_zeros(levels, groups).join(groups.select("lang", "source", "total", "terms"), ["lang", "source"])
    levels = keep(
        levels.select("lang", "word", "source", probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "bits")
    )
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = (
        groups.select("lang", "source").join(others, "lang").where("source != item")
        .join(pair_sums(levels), ["lang", "source", "item"], "left")
        .fillna(0, ["value"])
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))  # a row per source
    pairs = pairs.withColumn("rank", F.row_number().over(by_value)).withColumn("part", F.lit("pair"))

    p = probability(F.col("n"), F.col("total"), F.col("terms"))
    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    more = (
        counts.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
        .where("value > 0")
    )
    top = first_rows(more, ["lang", "source"], [F.desc("value"), F.col("item")], top_terms, "rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(top.withColumn("part", F.lit("term")).select(*columns))
