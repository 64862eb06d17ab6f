"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor when the smallest of its s-mers stands at its start or its
end. Whether a k-mer is chosen depends on nothing around it, so an edit changes only the anchors
it touches. A fingerprint holds the ``ANCHORS`` anchors with the smallest hashes (a bottom-k
sketch of all anchors of the whole text) in text order. Two fingerprints are alike by the sketch's
Jaccard estimate, times the share of common anchors that keep their order.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices, texts

K, S, ANCHORS = 12, 5, 128
_DIGITS = 8  # hexadecimal digits of one anchor

_COLUMNS = [
    ("doc_id", "long", pa.int64()),
    ("n_chars", "long", pa.int64()),
    ("edited_sha256", "string", pa.string()),
    ("fingerprint", "string", pa.string()),
    ("edited_fingerprint", "string", pa.string()),
    ("near_edited", "double", pa.float64()),
    ("near_next", "double", pa.float64()),
]
_DDL = ", ".join(f"{name} {kind}" for name, kind, _ in _COLUMNS)
_ARROW = pa.schema([(name, kind) for name, _, kind in _COLUMNS])


def _mixed(values: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 64-bit hashes of all closed syncmers of the whole text, in text order.

    A text without any (shorter than k, mostly) is one anchor as a whole; an empty one has none.
    """
    n = len(text)
    if n >= k:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        base = np.uint64(0x9E3779B97F4A7C15)
        small = points[: n - s + 1].copy()
        for i in range(1, s):
            small *= base
            small += points[i : n - s + 1 + i]
        small = _mixed(small)
        width = k - s + 1  # s-mers in a k-mer
        low, span = small, 1
        while span < width:
            step = min(span, width - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        last = small[width - 1 :]
        at = np.flatnonzero((small[: len(last)] == low) | (last == low))
        if at.size:
            whole = small[at]
            for i in (*range(s, k - s, s), k - s):
                whole = whole * base + small[at + i]
            return at, _mixed(whole)
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
    return np.zeros(1, np.int64), np.frombuffer(digest[:8], np.uint64)


def fingerprint(text: str, size: int = ANCHORS) -> str:
    """The anchors with the smallest hashes in the order of their first places, 8 digits each."""
    _, hashes = anchors(text)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 8 * size:  # what cannot be among the smallest need not be sorted
        bound = np.partition(short, 4 * size)[4 * size]
        few = short[short <= bound]
        short = few if len(np.unique(few)) >= size else short
    values, first = np.unique(short, return_index=True)
    first = np.sort(first[:size])
    return short[first].astype(">u4").tobytes().hex()


def _parsed(print_: str) -> list[str]:
    return [print_[i : i + _DIGITS] for i in range(0, len(print_), _DIGITS)]


def likeness(a: str, b: str, size: int = ANCHORS) -> float:
    """0 to 1. Equal fingerprints give 1, also two empty ones; an empty and another give 0."""
    if a == b:
        return 1.0
    left, right = _parsed(a), {anchor: i for i, anchor in enumerate(_parsed(b))}
    bottom = sorted({*left, *right})[:size]
    both = right.keys() & set(left)
    shared = sum(anchor in both for anchor in bottom)
    if not shared:
        return 0.0
    tails: list[int] = []  # longest rising chain of places: anchors that keep their order
    for place in (right[anchor] for anchor in left if anchor in both):
        at = bisect_left(tails, place)
        tails[at : at + 1] = [place]
    return shared / len(bottom) * len(tails) / len(both)


def edited(text: str, following: str) -> str:
    """The last half of the text (rounded down) gives way to as many code points of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _described(doc_id, text: str, print_: str, following: str, next_print: str) -> tuple:
    other = edited(text, following)
    other_print = print_ if other == text else fingerprint(other)
    sha = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
    near = likeness(print_, other_print), likeness(print_, next_print)
    return (doc_id, len(text), sha, print_, other_print, *near)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Describe each sorted row with the one after it; a range's last row is only looked at."""
    held, held_range = None, None
    for batch in in_slices(batches):
        done = []
        for range_, doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
            print_ = fingerprint(text)
            if range_ == held_range:
                done.append(_described(*held, text, print_))
            held, held_range = (doc_id, text, print_), range_
        if done:
            columns = [pa.array(column, kind) for column, (_, _, kind) in zip(zip(*done), _COLUMNS)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _ranges(rows: DataFrame) -> DataFrame:
    """``rows`` with ``range``, the number of one of as many ranges of ``doc_id`` as shuffles have tasks.

    Only the splitters, quantiles of the identifiers, pass the driver. NULL comes in the last range.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / count for i in range(1, count)]
    splitters = sorted({*rows.approxQuantile("doc_id", steps, 0.25 / count)}) if steps else []
    ranges = Bucketizer(
        splits=[-math.inf, *(splitters or [0.0]), math.inf],
        inputCol="place",
        outputCol="range",
    )
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(math.inf))
    return ranges.transform(rows.withColumn("place", place)).drop("place")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its fingerprint and those of its edited text.

    The next document is the next by ``doc_id``, ties by text; NULL identifiers come last; after
    the last comes the first, so a single row follows itself. NULL text is empty. Whole texts are
    read, of any length. Other columns are ignored; no rows in, no rows out.

    The texts are moved once, to ranges of identifiers. Each range also gets the first row of the
    range after it (one more row per range), so that its own last row has a next one.
    """
    rows = _ranges(texts(docs, id_col, text_col))
    # One row per range.
    firsts = sorted(
        (row["range"], row["first"])
        for row in rows.groupBy("range").agg(F.min("doc_id").alias("first")).collect()
    )
    after = [
        (firsts[i - 1][0], range_, first) for i, (range_, first) in enumerate(firsts)
    ]
    heads = rows.sparkSession.createDataFrame(after, "before double, head_range double, head_id long")
    same = (F.col("range") == F.col("head_range")) & F.col("doc_id").eqNullSafe(F.col("head_id"))
    closing = (
        rows.join(F.broadcast(heads), same)
        .groupBy("before", "doc_id")
        .agg(F.min("text").alias("text"))
        .select(F.col("before").alias("range"), "doc_id", "text", F.lit(1).alias("closing"))
    )
    every = rows.select("range", "doc_id", "text", F.lit(0).alias("closing")).unionByName(closing)
    return (
        every.repartitionByRange("range")
        .sortWithinPartitions("range", "closing", F.col("doc_id").asc_nulls_last(), "text")
        .select("range", "doc_id", "text")
        .mapInArrow(_in_order, _DDL)
    )
