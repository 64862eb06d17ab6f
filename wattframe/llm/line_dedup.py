"""Removing passages that an earlier document has, by aligning pairs of documents line by line.

A line is rare enough to tell documents apart only with some words in it, so each line is hashed
together with the fewest lines after it, and again with the fewest before it, that make
``block_words`` words: its runs. Any common block of that many words is covered by runs that both
documents have. A run names one partner, the first document that has it, so a run that a third of
all documents share gives one row per document and never a pair of two later ones; other documents
that share it need no further partner for it, since their common lines go by the first one's.

Each document is then aligned with each of its partners by patience: the runs that both have once
give the longest chain that rises in both, and what this leaves is aligned again, until no common
block remains. Aligned blocks go from the later document.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices
from wattframe.session import keep

#: A block of fewer words is left: single short lines meet by chance.
BLOCK_WORDS = 10
_LAST = (1 << 63) - 1
#: A line with anything that Python's ``split`` takes as part of a word.
_FILLED = r"(?U)[^\s\x1c-\x1f]"


def _order(id_col: str) -> Column:
    """Identifiers in order; rows without one come last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def line_runs(text: str, block_words: int = BLOCK_WORDS) -> list[tuple[bytes, int, int, int, int]]:
    """``(hash, first line, lines, first place, last place)`` of the runs of a text.

    Lines are numbered without blank ones, places with them. From each line on, and up to each line,
    there is one run: the shortest with ``block_words`` words. White space within a line counts as
    one space. A text with fewer words has no run.
    """
    hashes, places, before = [], [], [0]
    for place, line in enumerate(text.split("\n")):
        words = line.split()
        if words:
            raw = " ".join(words).encode("utf-8", "surrogatepass")
            hashes.append(hashlib.blake2b(raw, digest_size=16).digest())
            places.append(place)
            before.append(before[-1] + len(words))
    count = len(hashes)
    spans = {}
    stop = 0
    for start in range(count):
        while stop <= count and before[min(stop, count)] - before[start] < block_words:
            stop += 1
        if stop > count:
            break
        spans[start, stop] = None
    start = 0
    for stop in range(1, count + 1):
        while start + 1 < stop and before[stop] - before[start + 1] >= block_words:
            start += 1
        if before[stop] - before[start] >= block_words:
            spans[start, stop] = None
    found = []
    for start, stop in spans:
        run = hashes[start]
        if stop - start > 1:
            run = hashlib.blake2b(b"".join(hashes[start:stop]), digest_size=16).digest()
        found.append((run, start, stop - start, places[start], places[stop - 1]))
    return found


def _hashed_runs(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = [
                (doc, check, *found)
                for doc, check, text in zip(*(column.to_pylist() for column in batch.columns))
                for found in line_runs(text, block_words)
            ]
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, types)],
                names=["doc", "check", "run", "number", "lines", "place", "last_place"],
            )

    return run


def longest_chain(points: list[tuple[int, int]]) -> list[int]:
    """Indices of a longest chain that rises in the second value; points are sorted by the first.

    Patience sorting: each point goes on the leftmost pile it fits, with a link to the pile before.
    """
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(points)
    for i, (_, value) in enumerate(points):
        pile = bisect_left(tops, value)
        before[i] = piles[pile - 1] if pile else -1
        tops[pile : pile + 1] = [value]
        piles[pile : pile + 1] = [i]
    chain = []
    at = piles[-1] if piles else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def rising_chains(points: list[tuple[int, int]]) -> list[list[int]]:
    """All points dealt into the fewest chains that rise in the second value, in one pass.

    Patience sorting with its order turned round: each point goes on the pile with the largest top
    below it. Aligning again and again what a chain leaves ends with no fewer chains.
    """
    tops: list[int] = []  # negated, so that they rise from the first pile to the last
    piles: list[list[int]] = []
    for i, (_, value) in enumerate(points):
        pile = bisect_left(tops, 1 - value)
        if pile == len(piles):
            tops.append(-value)
            piles.append([i])
        else:
            tops[pile] = -value
            piles[pile].append(i)
    return piles


def aligned_blocks(shared: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Common blocks ``(first line here, first line there, lines)`` of two documents.

    ``shared``: the same of the runs that both have. The first alignment is the longest chain of the
    runs that both have once; the others take what is left. A block is what a chain has without a
    gap in either document.
    """
    shared = sorted(shared)
    points = [row[:2] for row in shared]
    often = Counter(there for _, there in points)
    once = [i for i, (_, there) in enumerate(points) if often[there] == 1]
    first = [once[i] for i in longest_chain([points[i] for i in once])]
    taken = set(first)
    left = [i for i in range(len(shared)) if i not in taken]
    chains = [first, *([left[i] for i in chain] for chain in rising_chains([points[i] for i in left]))]
    blocks: list[tuple[int, int, int]] = []
    for chain in chains:
        start = None
        for here, there, lines in (shared[i] for i in chain):
            if start is not None and here - there == start[0] - start[1] and here <= start[0] + start[2]:
                start[2] = max(start[2], here + lines - start[0])
                continue
            if start is not None:
                blocks.append(tuple(start))
            start = [here, there, lines]
        if start is not None:
            blocks.append(tuple(start))
    return blocks


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.struct(
        [("partner", pa.int64()), ("partner_check", pa.int64()), ("here", pa.int32()), ("there", pa.int32()), ("lines", pa.int32())]
    )
    for batch in in_slices(batches):
        docs, checks, masks, found = [], [], [], []
        for doc, check, rows in zip(*(column.to_pylist() for column in batch.columns)):
            partners: dict = {}
            spans: dict = {}
            for row in rows:
                first = row["first"]
                pair = partners.setdefault((first["doc"], first["check"]), [])
                pair.append((row["number"], first["number"], row["lines"]))
                spans[row["number"], row["lines"]] = row["place"], row["last_place"]
            blocks = [(*partner, *one) for partner in sorted(partners) for one in aligned_blocks(partners[partner])]
            mask = [False] * (1 + max(last for _, last in spans.values()))
            gone = {number for *_, here, _, lines in blocks for number in range(here, here + lines)}
            for (number, lines), (place, last) in spans.items():
                # The runs of a block cover all of its lines, and a run lies in a block whole.
                if number in gone:
                    mask[place : last + 1] = [True] * (last + 1 - place)
            docs.append(doc)
            checks.append(check)
            masks.append(mask)
            found.append([dict(zip(("partner", "partner_check", "here", "there", "lines"), one)) for one in blocks])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(docs, pa.int64()),
                pa.array(checks, pa.int64()),
                pa.array(masks, pa.list_(pa.bool_())),
                pa.array(found, pa.list_(block)),
            ],
            names=["doc", "check", "deleted", "blocks"],
        )


def deletions(
    docs: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc, check, deleted, blocks`` of the documents that share a block with an earlier one.

    ``doc`` is the identifier (the largest long for NULL) and ``check`` a hash of the text, which
    together name a document. ``deleted`` marks places from line 0 on, blank lines within a block too;
    ``blocks`` lists what was aligned with which partner, in numbers of lines that are not blank.
    """
    rows = docs.select(_order(id_col).alias("doc"), F.xxhash64(_text(text_col)).alias("check"), _text(text_col).alias("text"))
    runs = rows.mapInArrow(
        _hashed_runs(block_words),
        "doc long, check long, run binary, number int, lines int, place int, last_place int",
    )
    shared = runs.groupBy("run").agg(
        F.min(F.struct("doc", "check", "number")).alias("first"), F.max(F.struct("doc", "check")).alias("last")
    )
    several = (F.col("first.doc") != F.col("last.doc")) | (F.col("first.check") != F.col("last.check"))
    # Written, so that both sides of the join have an exchange and a frequent run can be split.
    shared = keep(shared.where(several).select("run", "first"))
    later = runs.join(shared, "run").where(
        (F.col("doc") != F.col("first.doc")) | (F.col("check") != F.col("first.check"))
    )
    # A set: rows that repeat a document add nothing to it.
    return (
        later.groupBy("doc", "check")
        .agg(F.collect_set(F.struct("first", "number", "lines", "place", "last_place")).alias("rows"))
        .mapInArrow(
            _aligned,
            "doc long, check long, deleted array<boolean>, blocks array<struct<partner: long,"
            " partner_check: long, here: int, there: int, lines: int>>",
        )
    )


def without_common_lines(
    docs: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs``, the text without the common blocks, and ``lines_deleted``.

    A line goes if it lies in a block of lines, of ``block_words`` words and more, that an earlier
    document has too, blank lines aside. Of what several documents share, the one with the smallest
    identifier keeps it; NULL identifiers
    come last, and equal identifiers are told apart by a hash of the text. Rows that repeat both are
    one document and get the same text. Blank lines are no lines of a block and stay, unless nothing
    else is left: then the text is empty. NULL and empty texts stay as they are, long ones are aligned
    whole. Other columns pass unchanged whatever their names (but ``lines_deleted`` is replaced); no
    rows in, no rows out.
    """
    gone = deletions(docs, block_words, id_col, text_col).select(
        F.col("doc").alias("__doc"), F.col("check").alias("__check"), F.col("deleted").alias("__deleted")
    )
    marked = docs.withColumns({"__doc": _order(id_col), "__check": F.xxhash64(_text(text_col))})
    joined = marked.join(gone, ["__doc", "__check"], "left")
    lines = F.split(_text(text_col), "\n")
    left = F.filter(
        lines, lambda line, i: ~(F.coalesce(F.get("__deleted", i), F.lit(False)) & line.rlike(_FILLED))
    )
    text = F.array_join(left, "\n")
    text = F.when(text.rlike(_FILLED), text).otherwise(F.lit(""))
    kept = F.col("__deleted").isNull()
    return joined.select(
        *[
            F.when(kept, F.col(f"`{name}`")).otherwise(text).alias(name) if name == text_col else F.col(f"`{name}`")
            for name in docs.columns
            if name != "lines_deleted"
        ],
        F.when(kept, F.lit(0)).otherwise(F.size(lines) - F.size(left)).cast("long").alias("lines_deleted"),
    )
