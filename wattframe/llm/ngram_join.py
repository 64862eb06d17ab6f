"""Components of documents whose word n-gram sets overlap by a given share (Jaccard).

Every set is a sorted list of 63-bit hashes of its n-grams, and documents with equal sets form one
class. Candidates come from prefixes: under one global order of all n-grams, two linked sets share
an n-gram among the first ``size - needed + 1`` of each. The order puts n-grams with small hashes
first, and among these the rare before the frequent. So only those have to be counted, what nobody
else has comes first, and most documents end with a prefix of such n-grams and no candidates at all.

Documents that share a prefix n-gram meet in one of two ways, by the first that they share. Nothing
before its place is common, so the places bound the overlap. A small group gives its pairs, pruned by
that bound and by the n-grams with small hashes that both have; only what these let through is
compared whole. From a large group go the members that the bound lets link with no other member.
The sets of the rest are put into a prefix tree, most frequent n-gram first; each document is looked up in the tree of those before
it. What many documents share is one path there, compared once for all of them, and a subtree is left
as soon as its remaining lengths cannot make up the overlap or all of it is already connected. So a
large group gives at most one edge per document. Each document first goes into the tree of its largest
group; of the groups that this leaves unconnected, those with almost the same members become one, so
that sets of near copies do not move once for each n-gram they share. Groups beyond ``BLOCK`` are split
into blocks that meet two by two.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.components import components
from wattframe.llm.tables import in_slices, texts
from wattframe.session import keep

#: A group of more documents is looked up in a tree, of fewer is paired.
SMALL_GROUP = 32
#: Documents, and n-grams in all, of a tree.
BLOCK, BLOCK_GRAMS = 2_000, 600_000
#: Above so many, the documents to compare are found by a shuffle instead of a broadcast (16 MB).
BROADCAST_ROWS = 500_000
#: Sets of at most so many n-grams are first compared by 16 bits of each, larger ones by 32.
NARROW = 4_096
#: Size classes of a factor e in a large group: 32 differ by 3 %.
CLASSES = 32
_TOP = 1 << 63
_HOT = 1 << 60  # stands for the count of an n-gram that is frequent in the sample


class _Hashes(dict):
    """64-bit hashes of words, remembered for a while."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = found
        return found


def gram_set(text: str, size: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 63-bit hashes of all word n-grams; of all words as one if they are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # only ASCII, both
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    base = np.uint64(0x9E3779B97F4A7C15 + 2 * (size - width))
    grams = each[: len(each) - width + 1].copy()
    for i in range(1, width):
        grams = grams * base + each[i : len(each) - width + 1 + i]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    return np.unique(grams >> np.uint64(1))


def _needed(total: int, percent: int) -> int:
    """The smallest overlap of two sets of ``total`` n-grams together that links them."""
    return -(-percent * total // (100 + percent))


def _region(percent: int) -> int:
    """N-grams with hashes below this are counted: a little more of them than prefixes have."""
    return _TOP * (100 - percent) // 90


def _prefix(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _described(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        bound = np.uint64(_region(percent))
        for batch in in_slices(batches):
            counts, inside, digests, regions = [], [], [], []
            for text in batch.column(1).to_pylist():
                grams = gram_set(text, size, hashes)
                count, low = len(grams), int(np.searchsorted(grams, bound))
                shown = grams[: max(low, _prefix(count, percent))] if count else grams
                counts.append(count)
                inside.append(low)
                digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                regions.append(shown.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(inside, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(regions, pa.binary()),
                    *batch.columns[2:],
                ],
                names=["doc_id", "n", "inside", "digest", "region", *batch.schema.names[2:]],
            )

    return run


def _exploded(frequent: np.ndarray):
    """Each n-gram of a region as a row, but for the frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            regions = [np.frombuffer(raw, np.int64) for raw in batch.column(1).to_pylist()]
            lengths = [len(region) for region in regions]
            grams = np.concatenate(regions) if regions else np.empty(0, np.int64)
            keys = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lengths)
            if len(frequent):
                rare = ~np.isin(grams, frequent)
                grams, keys = grams[rare], keys[rare]
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(keys)], names=["gram", "key"])

    return run


def _frequent_in(frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = []
            for raw in batch.column(3).to_pylist():
                region = np.frombuffer(raw, np.int64)
                found.append(region[np.isin(region, frequent)] if len(frequent) else region[:0])
            columns = [*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "inside", "frequent"])

    return run


def _frequent(rows: DataFrame) -> np.ndarray:
    """N-grams in a fair share of a sample's classes: they are dealt with apart from the others.

    The sample only chooses the way; any n-grams would do. At most 500 times a document's n-grams.
    """
    part = rows.where(F.pmod(F.xxhash64("digest"), F.lit(64)) == 0).dropDuplicates(["digest"])
    part = keep(part.select(F.xxhash64("digest").alias("key"), "region"))
    least = max(16, part.count() / 500)
    grams = part.mapInArrow(_exploded(np.empty(0, np.int64)), "gram long, key long")
    counts = grams.groupBy("gram").count().where(F.col("count") >= least)
    return np.array(sorted(row["gram"] for row in counts.collect()), np.int64)


def _one_of_each(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``key, n, inside, region`` of the row that stands for its class. Regions are not shuffled for
    that: it is the other rows of a class, most often few, that are looked up."""
    repeated = keep(names.where("copies > 1").select("digest", "key"))
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    others = keep(rows.select("row", "digest").join(repeated, "digest").where("row != key").select("row"))
    if others.count() <= BROADCAST_ROWS:
        others = F.broadcast(others)
    return rows.join(others, "row", "left_anti").select(F.col("row").alias("key"), "n", "inside", "region")


def _postings(classes: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """``gram, key, n, place``: the n-grams of each class's prefix that another class has too."""
    region = classes.select("key", "region").mapInArrow(_exploded(frequent), "gram long, key long")
    shared = (
        region.withColumn("df", F.count("*").over(Window.partitionBy("gram"))).where("df > 1")
    )
    bound = _region(percent)
    inner = F.col("gram") < bound
    own = shared.groupBy("key").agg(
        F.collect_list(
            F.struct((~inner).alias("outer"), F.when(inner, F.col("df")).otherwise(0).alias("df"), "gram")
        ).alias("grams"),
        F.count_if(inner).alias("inner"),
    )
    summary = classes.select("key", "n", "inside", "region").mapInArrow(
        _frequent_in(frequent), "key long, n long, inside long, frequent array<long>"
    )
    hot = F.transform(
        "frequent",
        lambda gram: F.struct(
            (gram >= bound).alias("outer"), F.lit(_HOT).alias("df"), gram.alias("gram")
        ),
    )
    hot_inner = F.size(F.filter("frequent", lambda gram: gram < bound))
    alone = F.col("inside") - F.coalesce("inner", F.lit(0)) - hot_inner  # nobody else has them
    length = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    none = F.array().cast("array<struct<outer:boolean,df:bigint,gram:bigint>>")
    ordered = F.array_sort(F.concat(F.coalesce("grams", none), hot))
    prefix = (
        summary.join(own, "key", "left")
        .withColumns({"alone": alone, "take": (length - alone).cast("int"), "ordered": ordered})
        .where((F.col("take") > 0) & (F.size("ordered") > 0))
    )
    taken = F.slice("ordered", F.lit(1), F.col("take"))
    return prefix.select("key", "n", "alone", F.posexplode(taken).alias("at", "item")).select(
        F.col("item.gram").alias("gram"), "key", "n", (F.col("alone") + F.col("at")).alias("place")
    )


def _without_nested(large: DataFrame) -> DataFrame:
    """Groups whose members all have one earlier group in common go.

    The common prefix order puts the n-grams of a shared passage in one order in all of its documents,
    so their groups are nested: whoever has the later n-gram in its prefix has the earlier one too. Every
    pair of such a group meets in the earlier group, which is not dropped in favour of a later one.
    """
    order = Window.partitionBy("key").orderBy("place")  # a document's prefix
    seen = large.withColumns({"before": F.lag("gram").over(order), "first": F.first("gram").over(order)})
    all_after_one = (F.min("before") == F.max("before")) & (F.count("before") == F.count("*"))
    all_begin_with_one = (F.min("first") == F.max("first")) & (F.min("first") != F.col("gram"))
    nested = F.coalesce(all_after_one | all_begin_with_one, F.lit(False))
    kept = seen.groupBy("gram").agg(nested.alias("nested")).where("NOT nested").select("gram")
    return large.join(kept, "gram", "left_semi")


def _with_partners(large: DataFrame, percent: int) -> DataFrame:
    """The members of large groups that the places let link with another member of the group.

    Two documents need to meet in the group of the first n-gram they share only. If that is this one,
    they have at most what stands from its place on in common, so the place gives the size ``most`` of
    the largest partner: x and y meet if ``n_y <= most_x`` and ``n_x <= most_y``. Members are counted
    by classes of both sizes, rounded down alike, so no pair is lost by the rounding.
    """
    most = F.floor((F.col("n") - F.col("place")) * (100 + percent) / percent) - F.col("n")
    size_class, most_class = (
        F.floor(F.log(F.greatest(size, F.lit(1))) * CLASSES).cast("int") for size in (F.col("n"), most)
    )
    members = large.withColumns({"size_class": size_class, "most_class": most_class})
    # A class of ``most`` is near that of the size, so a group has a bounded number of them.
    counts = members.groupBy("gram", "size_class", "most_class").agg(F.count("*").alias("number"))
    cells = counts.groupBy("gram").agg(F.collect_list(F.struct("size_class", "most_class", "number")).alias("cells"))
    fitting = F.aggregate(
        "cells",
        F.lit(0).cast("long"),
        lambda number, cell: number
        + F.when(
            (cell["size_class"] <= F.col("most_class")) & (cell["most_class"] >= F.col("size_class")), cell["number"]
        ).otherwise(F.lit(0).cast("long")),
    )
    itself = (F.col("size_class") <= F.col("most_class")).cast("long")
    return members.join(cells, "gram").where(fitting > itself).select(*large.columns)


def _needed_column(total: Column, percent: int) -> Column:
    # In whole numbers: a quotient above a whole one by rounding would ask for one more.
    return F.floor((total * percent + 99 + percent) / (100 + percent))


def _small_pairs(posted: DataFrame, percent: int) -> DataFrame:
    """``x, y`` from groups of at most ``SMALL_GROUP``, each pair once, that the places allow.

    Only the first shared n-gram's place counts: of those after it, some may be in large groups.
    """
    small = posted.where(F.col("members") <= SMALL_GROUP)
    left = small.select("gram", *[F.col(c).alias(f"{c}_x") for c in ("key", "n", "place")])
    right = small.select("gram", *[F.col(c).alias(f"{c}_y") for c in ("key", "n", "place")])
    shorter, longer = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")
    pairs = (
        left.join(right, "gram")
        .where((F.col("key_x") < F.col("key_y")) & (shorter * 100 >= longer * percent))
        .groupBy("key_x", "key_y")
        .agg(*[F.min(f"{c}_{side}").alias(f"{c}_{side}") for c in ("n", "place") for side in "xy"])
    )
    from_there = F.least(*[F.col(f"n_{side}") - F.col(f"place_{side}") for side in "xy"])
    enough = from_there >= _needed_column(F.col("n_x") + F.col("n_y"), percent)
    return pairs.where(enough).select(F.col("key_x").alias("x"), F.col("key_y").alias("y"))


def _likely(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs that can be linked by the n-grams with small hashes: all others count as common."""
    keys = pairs.select(F.explode(F.array("x", "y")).alias("key")).distinct()
    keys = keep(keys)
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    known = keep(
        rows.withColumnRenamed("row", "key").join(keys, "key", "left_semi").select("key", "n", "inside", "region")
    )

    def of(side: str) -> DataFrame:
        return known.select(F.col("key").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in known.columns[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            fine = []
            for total, low_x, low_y, rest, x, y in zip(*(column.to_pylist() for column in batch.columns[2:])):
                x, y = np.frombuffer(x, np.int64)[:low_x], np.frombuffer(y, np.int64)[:low_y]
                common = len(np.intersect1d(x, y, assume_unique=True))
                fine.append(common + rest >= _needed(total, percent))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["x", "y"]).filter(
                pa.array(fine, pa.bool_())
            )

    rest = F.least(F.col("n_x") - F.col("inside_x"), F.col("n_y") - F.col("inside_y"))
    both = pairs.join(of("x"), "x").join(of("y"), "y")
    total = F.col("n_x") + F.col("n_y")
    return both.select(
        "x", "y", total.alias("total"), "inside_x", "inside_y", rest.alias("rest"), "region_x", "region_y"
    ).mapInArrow(run, "x long, y long")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``key, grams`` of the wanted classes, from the text of one document of each."""
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in in_slices(batches):
            keys, grams = [], []
            for key, digest, text in zip(*(column.to_pylist() for column in batch.columns)):
                found = gram_set(text, size, hashes).tobytes()
                if hashlib.blake2b(found, digest_size=16).digest() == digest:
                    keys.append(key)
                    grams.append(found)
            columns = [pa.array(keys, pa.int64()), pa.array(grams, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "grams"])

    rows = docs.join(wanted, "doc_id").select("key", "digest", "text")
    # A repeated row gives its set again: its links are found again, which changes nothing.
    return keep(rows.mapInArrow(run, "key long, grams binary"))


def _of_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``table`` whose ``key`` is among the keys."""
    keys = keep(keys.distinct())
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return table.join(keys, "key", "left_semi")


def _of_pairs(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``table`` whose ``key`` is in one of the pairs ``x, y``."""
    return _of_keys(table, pairs.select(F.explode(F.array("x", "y")).alias("key")))


def _both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """The pairs with the columns of both their rows, as ``_x`` and ``_y``."""
    for side in "xy":
        named = [F.col(c).alias(f"{c}_{side}") for c in table.columns if c != "key"]
        pairs = pairs.join(table.select(F.col("key").alias(side), *named), side)
    return pairs


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low bits of each set's n-grams, distinct, and the set's size."""
    for batch in in_slices(batches):
        sets = [np.frombuffer(raw, np.uint64) for raw in batch.column(1).to_pylist()]
        marks = [np.unique(grams.astype(np.uint16 if len(grams) <= NARROW else np.uint32)) for grams in sets]
        columns = [pa.array([len(grams) for grams in sets], pa.int64()), pa.array([m.tobytes() for m in marks], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", "n", "marks"])


def most_common(n_x: int, marks_x: bytes, n_y: int, marks_y: bytes) -> int:
    """The overlap that two sets have at most by their marks.

    Common n-grams have common marks, and no set has fewer marks than n-grams but by those that share one.
    """
    x, y = (np.frombuffer(raw, np.uint16 if n <= NARROW else np.uint32) for n, raw in ((n_x, marks_x), (n_y, marks_y)))
    if x.dtype != y.dtype:
        x, y = (np.unique(marks.astype(np.uint16)) for marks in (x, y))
    return len(np.intersect1d(x, y, assume_unique=True)) + min(n_x - len(x), n_y - len(y))


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that can be linked by their marks: a quarter of the bytes of whole sets, or half."""
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = zip(*(column.to_pylist() for column in batch.columns[4:]))
            fine = [most_common(*row) >= _needed(row[0] + row[2], percent) for row in rows]
            kept = pa.RecordBatch.from_arrays(list(batch.columns[:4]), names=names)
            yield kept.filter(pa.array(fine, pa.bool_()))

    marks = _of_pairs(sets, pairs).mapInArrow(_marks, "key long, n long, marks binary")
    both = _both(pairs, marks).select(*names, "n_x", "marks_x", "n_y", "marks_y")
    return keep(both.mapInArrow(run, pairs.schema))


def _compared(percent: int):
    """Of pairs with both sets, those that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            keep_row = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep_row.append(common >= _needed(len(a) + len(b), percent))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["x", "y"]).filter(
                pa.array(keep_row, pa.bool_())
            )

    return run


class _Node:
    """A run of n-grams that all documents below it share, and the limits of those documents."""

    __slots__ = ("run", "grams", "below", "ends", "least", "most", "deepest", "single")

    def __init__(self, run: list[int]):
        self.run, self.grams = run, frozenset(run)
        self.below: dict[int, _Node] = {}
        self.ends: list[tuple[int, int]] = []  # (document, its size)
        self.least, self.most, self.deepest = 1 << 62, 0, 0
        self.single: int | None = None  # a document, if all below belong to its component


class PrefixTree:
    """Links of documents to those put in before; linked documents become one component."""

    def __init__(self, percent: int, parents: list[int]):
        self.percent, self.parents, self.root = percent, parents, _Node([])

    def find(self, doc: int) -> int:
        parents = self.parents
        while parents[doc] != doc:
            parents[doc] = parents[parents[doc]]
            doc = parents[doc]
        return doc

    def links(self, doc: int, size: int, grams: list[int]) -> Iterator[int]:
        """A linked document for each component that this one was not connected to."""
        own, percent = frozenset(grams), self.percent
        todo = [(self.root, 0)]
        while todo:
            node, common = todo.pop()
            if node.single is not None and self.find(node.single) == self.find(doc):
                continue
            if node.most * 100 < size * percent or size * 100 < node.least * percent:
                continue
            if node.run:
                common += len(own & node.grams)
                ahead = len(grams) - bisect_right(grams, node.run[-1])
                if common + min(ahead, node.deepest) < _needed(size + node.least, percent):
                    continue
            for other, other_size in node.ends:
                if common >= _needed(size + other_size, percent) and self.find(other) != self.find(doc):
                    self.parents[self.find(other)] = self.find(doc)
                    yield other
            likely = []
            for first, child in node.below.items():
                (likely if first in own else todo).append((child, common))
            todo += likely  # looked at first

    def add(self, doc: int, size: int, grams: list[int]) -> None:
        node, at = self.root, 0
        while True:
            rest = len(grams) - at
            new = not node.most
            node.least, node.most = min(node.least, size), max(node.most, size)
            node.deepest = max(node.deepest, rest)
            if new:
                node.single = doc
            elif node.single is not None and self.find(node.single) != self.find(doc):
                node.single = None
            if not rest:
                node.ends.append((doc, size))
                return
            child = node.below.get(grams[at])
            if child is None:
                child = node.below[grams[at]] = _Node(grams[at:])
                node, at = child, len(grams)
                continue
            run, same = child.run, 0
            limit = min(len(run), rest)
            while same < limit and run[same] == grams[at + same]:
                same += 1
            if same < len(run):  # split the run where the two part
                upper = _Node(run[:same])
                child.run, child.grams = run[same:], frozenset(run[same:])
                upper.below[run[same]] = child
                upper.least, upper.most, upper.single = child.least, child.most, child.single
                upper.deepest = child.deepest + len(child.run)
                node.below[grams[at]] = upper
                child = upper
            node, at = child, at + same


def tree_links(sizes: list[int], components_: list[int], sets: list[np.ndarray], percent: int) -> list:
    """Pairs of positions: enough links to connect whatever is linked, beyond the given components."""
    grams, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)
    order = np.full(len(grams), -1)
    order[shared[np.argsort(-counts[shared], kind="stable")]] = np.arange(len(shared))
    first: dict[int, int] = {}
    parents = [first.setdefault(component, i) for i, component in enumerate(components_)]
    tree = PrefixTree(percent, parents)
    found, at = [], 0
    lists = []
    for one in sets:
        ranks = order[places[at : at + len(one)]]
        lists.append(np.sort(ranks[ranks >= 0]).tolist())
        at += len(one)
    for doc in sorted(range(len(sizes)), key=sizes.__getitem__):
        found += [(doc, other) for other in tree.links(doc, sizes[doc], lists[doc])]
        tree.add(doc, sizes[doc], lists[doc])
    return found


def _tree_edges(percent: int):
    """Of each group of sorted rows ``part, component, grams``, the components that links connect.

    ``x, y``: a component and the smallest one of the group that it is connected to.
    """

    def edges(rows: list[tuple]) -> pa.RecordBatch:
        _, parts, raws = zip(*rows)
        sets = [np.frombuffer(raw, np.uint64) for raw in raws]
        found = tree_links([len(s) for s in sets], list(parts), sets, percent)
        roots = {part: part for part in parts}

        def root(part: int) -> int:
            while roots[part] != part:
                part = roots[part]
            return part

        for a, b in found:
            low, high = sorted((root(parts[a]), root(parts[b])))
            roots[high] = low
        moved = [part for part in roots if root(part) != part]
        columns = [pa.array(moved, pa.int64()), pa.array([root(part) for part in moved], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in in_slices(batches):
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        yield edges(group)
                    group = []
                group.append(row)
        if len(group) > 1:
            yield edges(group)

    return run


def _merged(members: DataFrame) -> DataFrame:
    """``gram, key, n, component`` with groups that have most members in common as one group.

    Near copies share most n-grams of their prefixes, and each such group would move all their sets
    again. The groups that have the same member of most groups become one, unless that makes more pairs
    than they have apart. Whoever shares a group before shares one after.
    """
    often = members.groupBy("key").agg(F.count("*").alias("often"))
    hub = F.max(F.struct("often", "key"))["key"].alias("hub")
    groups = keep(members.join(often, "key").groupBy("gram").agg(hub, F.count("*").alias("rows")))
    dealt = members.join(groups.select("gram", "hub"), "gram")
    together = keep(
        dealt.groupBy("hub", "key").agg(*[F.first(c).alias(c) for c in ("n", "component")])
    )
    apart = groups.groupBy("hub").agg(F.sum(F.col("rows") * F.col("rows")).alias("apart"))
    fewer = together.groupBy("hub").agg((F.count("*") * F.count("*")).alias("together")).join(apart, "hub")
    fewer = fewer.where("together <= apart").select("hub")
    named = (-1 - F.col("hub")).alias("gram")  # no n-gram is negative
    return (
        together.join(fewer, "hub", "left_semi")
        .select(named, "key", "n", "component")
        .unionByName(dealt.join(fewer, "hub", "left_anti").select("gram", "key", "n", "component"))
    )


def _in_trees(members: DataFrame, sets: DataFrame, percent: int, across: bool = True) -> DataFrame:
    """Connected components within groups; ``members`` has ``gram, key, n, component``.

    A group too large for one tree is cut into blocks by a hash; with ``across`` every two of them
    share a tree, without, each has its own.
    """
    totals = members.groupBy("gram").agg(F.count("*").alias("rows"), F.sum("n").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK), F.ceil(F.col("grams") / BLOCK_GRAMS))
    totals = totals.where("rows > 1").select("gram", blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("key"), F.col("blocks"))
    alone = (F.col("blocks") == 1) | F.lit(not across)
    others = F.when(alone, F.array(block)).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: other != block)
    )
    dealt = members.join(totals, "gram").select(
        "gram", "key", "component", block.alias("block"), F.explode(others).alias("other")
    )
    part = F.xxhash64("gram", F.least("block", "other"), F.greatest("block", "other"))
    dealt = dealt.select(part.alias("part"), "key", "component")
    rows = dealt.join(_of_keys(sets, dealt.select("key")), "key")
    return (
        rows.select("part", "component", "grams")
        .repartition("part")
        .sortWithinPartitions("part", "component")
        .mapInArrow(_tree_edges(percent), "x long, y long")
    )


def linked_components(
    docs: DataFrame,
    size: int = 4,
    percent: int = 85,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_text: bool = False,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    With ``by_text`` also ``text_hash``, which tells texts of one identifier apart (Spark's 64-bit xxHash;
    of NULL as of an empty text), and ``component``, a number that two components never share even if
    they have the same smallest identifier (NULL if linked with nothing for want of words or identifier).

    Words are runs without ASCII white space, A-Z lower-cased; a document's set has its distinct
    ``size``-word shingles, or all words as one if there are fewer. Two documents link when
    ``100 * common >= percent * together``; ``component_id`` is the smallest identifier that links
    reach. Empty and NULL texts have empty sets, link with nothing and are their own component, as
    are rows with a NULL identifier (their component is NULL). Repeated rows get the same result;
    rows that repeat an identifier with other texts have each text's result. Texts of any length are
    read whole; other columns are ignored; no rows in, no rows out.
    """
    own = texts(docs, id_col, text_col)
    hashed = own.withColumn("text_hash", F.xxhash64("text")) if by_text else own
    rows = keep(
        hashed.mapInArrow(
            _described(size, percent),
            "doc_id long, n long, inside long, digest binary, region binary" + (", text_hash long" if by_text else ""),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    able = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    frequent = _frequent(able)
    names = keep(
        able.groupBy("digest").agg(
            F.min("row").alias("key"),
            F.min("doc_id").alias("smallest"),
            F.min_by("doc_id", "row").alias("doc_id"),
            F.count("*").alias("copies"),
        )
    )
    classes = _one_of_each(able, names)
    posted = keep(_postings(classes, frequent, percent))
    groups = posted.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1")
    posted = keep(posted.join(groups, "gram"))
    pairs = keep(_likely(keep(_small_pairs(posted, percent)), rows, percent))
    large = _without_nested(posted.where(F.col("members") > SMALL_GROUP))
    large = keep(_with_partners(keep(large), percent))
    keys = (
        pairs.select(F.col("x").alias("key"))
        .unionByName(pairs.select(F.col("y").alias("key")))
        .unionByName(large.select("key"))
        .distinct()
    )
    wanted = keep(names.select("key", "doc_id", "digest").join(keys, "key", "left_semi"))
    sets = _sets(own, wanted, size)

    # Each document in the tree of its largest group first: most of what is linked is connected
    # there, and as no document is in two of these trees, their components are known at once.
    most = F.struct("members", "gram")
    homes = large.groupBy("key").agg(F.max_by("gram", most).alias("gram"), F.first("n").alias("n"))
    homes = homes.withColumn("component", F.col("key"))
    known = keep(_in_trees(homes, sets, percent, across=False)).toDF("node", "root")
    named = large.join(known.withColumnRenamed("node", "key"), "key", "left").select(
        "gram", "key", "n", F.coalesce("root", "key").alias("component")
    )
    open_ = named.groupBy("gram").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    apart = keep(named.join(open_.where("a != b").select("gram"), "gram", "left_semi"))
    more = keep(_in_trees(keep(_merged(apart)), sets, percent))

    def root_of(side: str) -> DataFrame:
        return known.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))

    unknown = (
        pairs.join(root_of("x"), "x", "left")
        .join(root_of("y"), "y", "left")
        .withColumns({"root_x": F.coalesce("root_x", "x"), "root_y": F.coalesce("root_y", "y")})
        .where("root_x != root_y")
        .select("x", "y", "root_x", "root_y")
    )
    unknown = _alike(keep(unknown), sets, percent)
    checked = (
        _both(unknown, _of_pairs(sets, unknown))
        .select("root_x", "root_y", "grams_x", "grams_y")
        .mapInArrow(_compared(percent), "x long, y long")
    )
    roots = keep(components(more.unionByName(checked))).toDF("component", "last")
    rooted = (
        names.drop("copies").join(known.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("root", "key"))
        .join(roots, "component", "left")
        .select("digest", "smallest", F.coalesce("last", "component").alias("root"))
    )
    reached = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    more_columns = ["text_hash", "component"] if by_text else []
    named_classes = rooted.join(reached, "root").select("digest", "component_id", F.col("root").alias("component"))
    linked = able.drop("row", "inside", "region").join(named_classes, "digest")
    rest = rows.where((F.col("n") == 0) | F.col("doc_id").isNull()).withColumns(
        {"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")}
    )
    return (
        linked.select("doc_id", "n", "component_id", *more_columns)
        .unionByName(rest.select("doc_id", "n", "component_id", *more_columns))
        .withColumnRenamed("n", "n_shingles")
    )
