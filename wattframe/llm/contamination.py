"""Benchmark passages in documents, found by an Aho-Corasick automaton.

Questions and answers of a benchmark are normalised to words. Every window of consecutive words of an
item is a pattern of one automaton, which reads each normalised text once and reports all windows at
once, however many there are. What it finds is mapped back to the words and to the characters of the
original text.

The documents are neither shuffled nor joined: the windows go to the tasks. A benchmark is small
beside a corpus, but not of a fixed size, so its windows are dealt into blocks of at most ``BLOCK_BYTES``;
the driver and a task hold one block at a time, and each further block is a further pass over the texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices
from wattframe.session import keep

#: Words of a window; a shorter item is one window.
WINDOW = 10
#: Bytes of window text in one automaton, which takes about 40 bytes of memory for each.
BLOCK_BYTES = 6 << 20

#: Lower-cases A-Z and turns all ASCII but letters and digits into spaces, byte by byte: bytes of
#: other characters are from 0x80 upwards in UTF-8 and stay.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")

_FOUND = (
    "doc_id long, digest string, n_words long, "
    "spans array<struct<first: int, words: int, begin: int, end: int>>, items array<long>"
)
_SPAN = pa.struct([(name, pa.int32()) for name in ("first", "words", "begin", "end")])
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.string()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(_SPAN)),
        ("items", pa.list_(pa.int64())),
    ]
)


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 64):
            for item, text in zip(*(column.to_pylist() for column in batch.columns)):
                words = (text or b"").translate(_NORMAL).split()
                k = min(size, len(words))
                found = {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(list(found), pa.binary())],
                    names=["item_id", "window"],
                )

    return run


def windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, window`` for each distinct window (UTF-8 words with a space between) of each item."""
    items = benchmark.select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    return items.mapInArrow(_windows(size), "item_id long, window binary").distinct()


def blocks(pairs: DataFrame, block_bytes: int) -> Iterator[dict[bytes, list[int]]]:
    """The windows with their items, as many at a time as ``block_bytes`` hold (one at least).

    The rows stream through the driver partition by partition. A window that more items have than a
    block has room for comes again in the next one, with the rest of its items.
    """
    block: dict[bytes, list[int]] = {}
    held = 0
    for item, window in pairs.orderBy("window", "item_id").toLocalIterator():
        window = bytes(window)
        cost = 8 if window in block else len(window) + 8
        if block and held + cost > block_bytes:
            yield block
            block, held, cost = {}, 0, len(window) + 8
        held += cost
        named = block.setdefault(window, [])
        if item is not None:
            named.append(item)
    if block:
        yield block


def automaton(block: dict[bytes, list[int]]):
    """Automaton over `` w1 w2 .. wn `` in Latin-1, one letter per byte; values: words, items."""
    machine = ahocorasick.Automaton()
    for window, items in block.items():
        machine.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
    machine.make_automaton()
    return machine


def hits(machine, words: list[bytes]) -> tuple[np.ndarray | None, set[int]]:
    """Which words are inside an occurrence of a window, and the items that have such windows."""
    line = b" " + b" ".join(words) + b" "
    found = list(machine.iter(line.decode("latin-1"))) if words else []
    if not found:
        return None, set()
    # The space behind a window's last word is as many spaces after the first as there are words.
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in found])
    first = last - [count for _, (count, _) in found]
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last, -1)
    items = {id(named): named for _, (_, named) in found}
    return np.cumsum(steps[:-1]) > 0, set().union(*items.values())


def spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words with their place in the original text: code points, the end not included."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    places = [m.span() for m in _WORD.finditer(text.translate(_NORMAL))]
    characters = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [
        {
            "first": int(start),
            "words": int(stop - start),
            "begin": int(characters[places[start][0]]),
            "end": int(characters[places[stop - 1][1]]),
        }
        for start, stop in zip(edges[::2], edges[1::2])
    ]


def _scan(block, whole: bool, digests: bool):
    """``whole`` reports every document, else only those with a hit; ``digests`` names their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(block.value) if block is not None and block.value else None
        for batch in in_slices(batches):
            rows = []
            for doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
                text = text or b""
                words = text.translate(_NORMAL).split()
                hit, items = hits(machine, words) if machine else (None, set())
                if hit is None and not whole:
                    continue
                rows.append(
                    {
                        "doc_id": doc_id,
                        "digest": hashlib.sha256(b"%r " % doc_id + text).hexdigest() if digests else None,
                        "n_words": len(words),
                        "spans": [] if hit is None else spans(text, hit),
                        "items": sorted(items),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def joined_spans(lists: list[list[dict]]) -> list[dict]:
    """Spans of several blocks as runs of hit words: what overlaps or touches becomes one."""
    joined: list[dict] = []
    for span in sorted((span for spans_ in lists for span in spans_), key=lambda s: s["first"]):
        last = joined[-1] if joined else None
        if last and span["first"] <= last["first"] + last["words"]:
            if span["first"] + span["words"] > last["first"] + last["words"]:
                last.update(words=span["first"] + span["words"] - last["first"], end=span["end"])
        else:
            joined.append(dict(span))
    return joined


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        rows = [
            {
                "doc_id": row["doc_id"],
                "digest": row["digest"],
                "n_words": row["n_words"],
                "spans": joined_spans([found["spans"] for found in row["found"] or []]),
                "items": sorted({item for found in row["found"] or [] for item in found["items"]}),
            }
            for row in batch.to_pylist()
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, spans, items``.

    ``spans`` are the longest runs of words inside occurrences of a window: ``first`` word, number of
    ``words``, ``begin`` and ``end`` in the original text (code points). ``items`` are the sorted ids of
    the items with an occurring window. NULL and empty texts have no words; an item without words has
    no window. Repeated rows each get their row; a repeated ``item_id`` counts as one item; an item
    without id marks words but is not listed. Texts are read whole, however long. Other columns are
    ignored, so their names cannot clash; no documents, no rows; no benchmark, no hits.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    pairs = keep(windows(benchmark, window, item_id_col, item_text_col))
    named = [spark.sparkContext.broadcast(b) for b in blocks(pairs, block_bytes)] or [None]
    several = len(named) > 1
    everything = texts.mapInArrow(_scan(named[0], True, several), _FOUND)
    if not several:
        return everything.drop("digest")
    # Documents with a hit in a block, from one pass each; a document and its text are known by digest.
    everything = keep(everything)
    struct = F.struct("spans", "items")
    parts = [everything.where(F.size("spans") > 0)] + [
        keep(texts.mapInArrow(_scan(block, False, True), _FOUND)) for block in named[1:]
    ]
    found = None
    for part in parts:
        once = part.groupBy("digest").agg(F.first(struct).alias("hit"))
        found = once if found is None else found.unionByName(once)
    found = keep(found.groupBy("digest").agg(F.collect_list("hit").alias("found")))  # one entry per block
    joined = everything.drop("spans", "items").join(found, "digest", "left")
    return joined.select("doc_id", "digest", "n_words", "found").mapInArrow(_joined, _FOUND).drop("digest")


def audited(found: DataFrame) -> DataFrame:
    """The digest of :func:`contaminated_spans` that a report shows, one row per row."""
    names = F.sort_array(F.transform("items", lambda item: item.cast("string")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["words"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
