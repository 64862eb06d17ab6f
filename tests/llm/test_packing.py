import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import wattframe.llm.packing as packing
from conftest_llm import AWKWARD, prose
from wattframe.llm.packing import _Words, cutting_plan, packed
from wattframe.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def test_words_give_the_tokenizers_ids(tokenizer):
    texts = [text or "" for _, text in AWKWARD] + [
        "It's don't !'s '' ''s x1² ½a 'RE we're THE,. a.b,c 'tis ªº ŉ ǅ ẞ ß. . , ,. ...",
        "Σας a\x1cb \x85 \xa0z <|endoftext|> e\u0301 \u212b",
    ]
    words = _Words(TOKENIZER)
    for _ in range(2):  # learning, and from memory
        for text, raw in zip(texts, words.encode(texts)):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(raw, "<u4").tolist() == ids


def test_signs_behind_letters(tokenizer):
    """Whatever signs end a word, its letters and its signs give the tokenizer's ids."""
    texts = [
        " ".join(f"{word}{signs}" for signs in (".", ",%%%", "###", "'.", "''", "_", "_-", "!!", "'", ".'\"", "^`|~"))
        for word in ("word", "Straße", "it's", "élan", "x1", "a.b", "ªº", "'s", "x\xad", "don't")
    ]
    words = _Words(TOKENIZER)
    for text, raw in zip(texts * 2, words.encode(texts) + words.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    asked = []
    words._whole = lambda text: asked.append(text) or b""
    words.encode([f"abc{word}.,%" for word in "defgh"])
    assert asked == [".,%"]  # letters and signs are known apart


def test_words_in_memory_are_bounded():
    """Texts with ever new words leave a worker with at most some 40 MB of them."""
    words = _Words(TOKENIZER)
    text = [" ".join("n" + "".join(chr(97 + int(c)) for c in str(i)) for i in range(at, at + 50_000)) for at in range(0, 700_000, 50_000)]
    for one in text:
        words.encode([one])
    held = [words.known, words.before]
    assert sum(sys.getsizeof(x) for part in held for item in part.items() for x in item) < 40e6


def test_portions_follow_the_bytes_of_texts():
    lengths = [10, 399_000, 2_000_000, 5, 0, 300_000, 300_000, 0]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(lengths)), pa.int64()), pa.array(["x" * n for n in lengths])], names=["doc_id", "text"]
    )
    parts = [part.column(0).to_pylist() for part in packing._portions(iter([batch, batch.slice(0, 0)]))]
    assert sum(parts, []) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in part[1:]) < packing.PORTION for part in parts)


@pytest.mark.parametrize("seed", range(3))
def test_plan_meets_the_demand(seed):
    rng = random.Random(seed)
    demand = Counter(rng.randint(1, 128) for _ in range(5000))
    plan = cutting_plan(dict(demand), 128)
    got = Counter()
    for pattern, times in plan:
        assert sum(size * n for size, n in pattern.items()) <= 128
        for size, n in pattern.items():
            got[size] += n * times
    assert got == demand
    by_size = sum(size * n for size, n in demand.items()) / 128
    alone = sum(n for size, n in demand.items() if size > 64)  # no two of these fit together
    assert sum(times for _, times in plan) < 1.03 * max(by_size, alone) + 2


def test_plan_without_demand():
    assert cutting_plan({}, 128) == [] and cutting_plan({3: 0}, 128) == []


def check(rows, found, tokenizer):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    by_id = defaultdict(list)
    for doc_id, text in rows:
        by_id[doc_id].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    assert by_id.keys() == pieces.keys()
    for doc_id, documents in by_id.items():
        want = Counter()
        for ids in documents:
            for start in range(0, len(ids), 2048):
                piece = ids[start : start + 2048]
                want[start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
        assert want == Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc_id])
    return len(sequences)


def test_round_trip(awkward, tokenizer):
    check(AWKWARD, packed(awkward, TOKENIZER).collect(), tokenizer)


def test_little_padding(docs, tokenizer):
    rng = random.Random(5)
    rows = [(i, " ".join(prose(i, rng.randint(1, 900)))) for i in range(300)]
    found = packed(docs(rows), TOKENIZER).collect()
    count = check(rows, found, tokenizer)
    assert sum(r.length for r in found) > 0.95 * 2048 * count


def test_ids_come_along(docs):
    (row,) = packed(docs([(1, "hello world")]), TOKENIZER, with_ids=True).collect()
    assert row.ids[-1] == 1 and zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32


def test_nothing(nothing):
    assert packed(nothing, TOKENIZER).collect() == []
