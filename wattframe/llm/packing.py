"""Packing documents into training sequences as a cutting-stock problem.

A document is cut into full sequences and one rest. The rests' length histogram (a bounded number
of bins) is the demand of a cutting-stock problem: a linear program over patterns of bins that fit a
sequence, whose columns a knapsack dynamic program generates by the program's dual prices. The
rounded patterns are then handed to the documents by their rank within their bin, so the driver
sees nothing but the histogram.
"""

from __future__ import annotations

import os
import re
import string
import sys
import types
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.tables import texts
from wattframe.operators.ranking import rank_all
from wattframe.session import keep

SEQUENCE, END_ID = 2048, 1
#: Token counts that share a bin; a bin counts as its largest length. Divides the sequence.
BIN = 16
#: Words whose ids a Python worker remembers; of more, those not met lately go. Bounds its memory:
#: about 200 bytes each.
REMEMBERED = 200_000
#: About so many bytes of text a task splits into words at once.
PORTION = 400_000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_ARROW = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
)
_WITH_IDS = _ARROW.append(pa.field("ids", pa.list_(pa.int32())))

#: Characters whose normalised lower-case form is that of each alone, whatever stands beside them,
#: without those that Python and the tokenizer do not both take for white space.
_PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")
#: Ends the last token of every word in the vocabulary.
_WORD_END = "</w>"
#: A run of these behind letters is a word of its own for the tokenizer.
_SIGNS = string.punctuation


class _Words:
    """Token ids of texts, word by word.

    The tokenizer treats white space as a border that no token crosses, so a text's ids are those of
    its words in a row, and of letters with signs behind them those of the letters and of the signs.
    Only new words go to the tokenizer. Texts with other than plain characters go to it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.by_words = bool(self.ends.any()) and not self._whole(" \t\n\v\f\r ")
        # The same merges for plain small letters, which nothing has to normalise or split.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = Sequence(
            [WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        probe = ["probe", "\u00e0b\u00e7", "it", "\u00df\u00f1"]
        self.by_merges = self.by_words and self._encoded(self.merges, " ".join(probe)) == b"".join(
            map(self._whole, probe)
        )
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str) -> _Words:
        """The tokenizer and the words of this Python worker, which runs one task after another.

        This package travels by value, so its own modules begin anew with each task.
        """
        memory = sys.modules.setdefault("_words_of_worker", types.ModuleType("_words_of_worker")).__dict__
        if path not in memory:
            memory[path] = cls(path)
        return memory[path]

    @staticmethod
    def _encoded(tokenizer, text: str) -> bytes:
        (found,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        return self._encoded(self.tokenizer, text)

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only, each one run of tokens that a word end closes, in one call."""
        raw = self._encoded(self.merges if self.by_merges else self.tokenizer, " ".join(words))
        ends = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1) * 4
        if len(ends) != len(words):  # not such a vocabulary
            return [self._whole(word) for word in words]
        starts = [0, *ends.tolist()]
        return [raw[i:j] for i, j in zip(starts, starts[1:])]

    def _learn(self, words: set[str]) -> None:
        known, signs = self.known, self.signs
        letters, signed = [], []
        for word in words:
            if word.isalpha():
                letters.append(word)
            elif (stem := word.rstrip(_SIGNS)).isalpha():
                signed.append((word, stem))
            else:
                known[word] = self._whole(word)
        fresh = list({stem for _, stem in signed}.difference(known, letters))
        if letters or fresh:
            found = self._letters(letters + fresh)
            known.update(zip(letters, found))
            stems = dict(zip(fresh, found[len(letters) :]))
        for word, stem in signed:
            behind = word[len(stem) :]
            if behind not in signs:
                if len(signs) > 1000:
                    signs.clear()
                signs[behind] = self._whole(behind)
            known[word] = (stems.get(stem) or known[stem]) + signs[behind]

    def encode(self, batch: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.known) > REMEMBERED // 2:
            self.before, self.known = self.known, {}
        split = [
            text.lower().split() if self.by_words and "<|" not in text and _PLAIN.fullmatch(text) else None
            for text in batch
        ]
        new = set().union(*filter(None, split)).difference(self.known)
        again = {word: self.before[word] for word in new if word in self.before}
        self.known.update(again)
        new.difference_update(again)
        if new:
            self._learn(new)
        ids = self.known.__getitem__
        return [
            self._whole(text) if words is None else b"".join(map(ids, words))
            for text, words in zip(batch, split)
        ]


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of less than ``PORTION`` bytes of text behind their first row's."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // PORTION)) + 1).tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def _tokenised(path: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words.of_worker(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in _portions(batches):
            rows, ids = [], []
            found = words.encode(batch.column(1).to_pylist())
            for doc_id, raw in zip(batch.column(0).to_pylist(), found):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, size):
                    piece = raw[4 * start : 4 * (start + size)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
            columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
            if rows and with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            if rows:
                yield pa.RecordBatch.from_arrays(columns, schema=_WITH_IDS if with_ids else _ARROW)

    return run


def pieces(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each document as its full sequences and one rest; ``with_ids`` adds the ids themselves."""
    schema = _PIECES + (", ids array<int>" if with_ids else "")
    return texts(docs, id_col, text_col).mapInArrow(
        _tokenised(tokenizer, size, end_id, with_ids), schema
    )


def _knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, Counter]:
    """The pattern of highest price that fits: unbounded knapsack by dynamic programming."""
    best = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for space in range(1, room + 1):
        fitting = np.searchsorted(sizes, space, side="right")  # sizes rise
        best[space], choice[space] = best[space - 1], -1
        if fitting:
            values = prices[:fitting] + best[space - sizes[:fitting]]
            at = int(values.argmax())
            if values[at] > best[space] + 1e-12:
                best[space], choice[space] = values[at], at
    pattern: Counter = Counter()
    space = room
    while space > 0:
        if choice[space] < 0:
            space -= 1
        else:
            pattern[int(choice[space])] += 1
            space -= int(sizes[choice[space]])
    return float(best[room]), pattern


def _linear_program(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[Counter, float]]:
    """Patterns and how often each is used at the optimum, by column generation.

    Starts from patterns of one bin each and brings in the column with the best reduced cost until
    none has any. The bound on rounds is far beyond what 128 bins take (about 20 a bin).
    """
    count = len(sizes)
    basis = [Counter({i: int(room // sizes[i])}) for i in range(count)]
    inverse = np.diag([1.0 / p[i] for i, p in enumerate(basis)])
    used = inverse @ demand
    for _ in range(200 * count):
        prices = inverse.sum(axis=0)  # every pattern costs one sequence
        worth, pattern = _knapsack(np.maximum(prices, 0), sizes, room)
        if worth <= 1 + 1e-7:
            break
        column = np.zeros(count)
        for i, times in pattern.items():
            column[i] = times
        step = inverse @ column
        ratio = np.full(count, np.inf)
        rising = step > 1e-9
        if not rising.any():
            break
        ratio[rising] = used[rising] / step[rising]
        leaving = int(ratio.argmin())
        used -= ratio[leaving] * step
        used[leaving] = ratio[leaving]
        used = np.maximum(used, 0)
        pivot = inverse[leaving] / step[leaving]
        inverse -= np.outer(step, pivot)
        inverse[leaving] = pivot
        basis[leaving] = pattern
    return [(pattern, float(times)) for pattern, times in zip(basis, used) if times > 1e-9]


def cutting_plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """``(pattern, times)`` so that every bin's demand is met exactly; a pattern maps bin to count.

    Bins are sizes from 1 to ``room``. The program's solution is rounded down; what is left, less
    than one pattern per bin, is packed largest first into the fullest sequence with space.
    """
    left = Counter({size: n for size, n in histogram.items() if n > 0})
    plan: list[tuple[dict[int, int], int]] = []
    if not left:
        return plan
    sizes = np.array(sorted(left))
    demand = np.array([left[int(s)] for s in sizes], float)
    for pattern, times in _linear_program(sizes, demand, room):
        named = {int(sizes[i]): n for i, n in pattern.items()}
        whole = min([int(times + 1e-6), *(left[s] // n for s, n in named.items())])
        if whole:
            plan.append((named, whole))
            left.subtract({s: n * whole for s, n in named.items()})
    open_: list[list] = [[] for _ in range(room + 1)]  # by space left
    rest: list[Counter] = []
    for size in sorted(left, reverse=True):
        for _ in range(left[size]):
            space = next((x for x in range(size, room + 1) if open_[x]), None)
            bin_ = open_[space].pop() if space is not None else Counter()
            if space is None:
                space = room
                rest.append(bin_)
            bin_[size] += 1
            open_[space - size].append(bin_)
    merged = Counter(tuple(sorted(b.items(), reverse=True)) for b in rest)
    return plan + [(dict(pattern), times) for pattern, times in merged.items()]


def _places(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``bin, from, to, each, sequence, slot``: which ranks of a bin a pattern takes."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in plan:
        slot = 0
        for size, each in sorted(pattern.items(), reverse=True):
            begin = taken[size]
            taken[size] += each * times
            rows.append((size, begin, taken[size], each, sequence, slot))
            slot += each
        sequence += times
    return rows


def assigned(cut: DataFrame, size: int = SEQUENCE, bin_width: int = BIN) -> DataFrame:
    """Give each piece (with ``doc_id, start, length``) its ``sequence_id`` and ``offset``."""
    if size % bin_width:
        raise ValueError("the bins' width must divide the sequence")
    spark = cut.sparkSession
    room = size // bin_width
    binned = cut.withColumn("bin", F.ceil(F.col("length") / bin_width).cast("int"))
    # At most `room` rows.
    histogram = {row[0]: row[1] for row in binned.groupBy("bin").count().collect()}
    plan = cutting_plan(histogram, room)
    places = spark.createDataFrame(
        _places(plan), "bin int, begin long, end long, each long, first_sequence long, first_slot long"
    )
    before, bases = 0, []
    for bin_ in sorted(histogram):
        bases.append((bin_, before))
        before += histogram[bin_]
    base = spark.createDataFrame(bases, "bin int, before long")
    order = [F.col("bin"), F.col("doc_id").asc_nulls_last(), F.col("start"), *_ties(cut)]
    ranked = rank_all(binned, order, "rank")
    # Both small tables are bounded by the number of bins: a basis has a pattern for each.
    in_bin = F.col("rank") - F.col("before") - 1
    placed = (
        ranked.join(F.broadcast(base), "bin")
        .withColumn("in_bin", in_bin)
        .join(F.broadcast(places), "bin")
        .where((F.col("in_bin") >= F.col("begin")) & (F.col("in_bin") < F.col("end")))
    )
    within = F.col("in_bin") - F.col("begin")
    slots = placed.withColumns(
        {
            "sequence_id": F.col("first_sequence") + F.floor(within / F.col("each")),
            "slot": F.col("first_slot") + within % F.col("each"),
        }
    )
    # A sequence's pieces: at most `size` rows.
    before_it = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return slots.select(
        *cut.columns,
        "sequence_id",
        F.coalesce(F.sum("length").over(before_it), F.lit(0)).alias("offset"),
    )


def _ties(cut: DataFrame) -> list:
    return [F.col(name) for name in ("ids_crc32", "doc_tokens") if name in cut.columns]


def packed(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE,
    bin_width: int = BIN,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every id of every document, with the end id after it, is in exactly one piece; NULL and empty
    texts are just the end id. Texts of any length are cut into full sequences and a rest. Documents
    that repeat an identifier are packed each by itself; NULL identifiers stay NULL and come last.
    Other columns are ignored; no rows in, no rows out. ``with_ids`` adds the ids (``array<int>``).
    """
    cut = keep(pieces(docs, tokenizer, size, end_id, with_ids, id_col, text_col))
    return assigned(cut, size, bin_width)
