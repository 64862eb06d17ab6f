import hashlib
import random
import re

import pytest

from conftest_llm import AWKWARD
from wattframe.llm.contamination import audited, contaminated_spans

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


def expected(docs, items):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, named = set(), set()
        for item_id, item_text in items:
            v = words(item_text)
            k = min(10, len(v))
            patterns = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in patterns:
                    hit.update(range(i, i + k))
                    named.add(item_id)
        named = sorted(str(item) for item in named if item is not None)
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    few = [f"w{i}" for i in range(40)] + ["É", "ß9", "Übung", "naïve"]
    items = [(i, " ".join(rng.choice(few) for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 40])))) for i in range(30)]
    items += [(3, items[12][1]), (5, None), (None, "null id " * 4), (31, items[20][1].upper())]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(6)):
            body = (rng.choice(items)[1] or "").split()
            parts += rng.choice([body, body[3:], body[:-2], [rng.choice(few) for _ in range(20)]])
        text = "".join(word + rng.choice([" ", "\n", ", ", "--", "  ", "\t."]) for word in parts)
        docs.append((i, rng.choice([text, text.title()])))
    return docs + [(doc_id, text) for doc_id, text, *_ in AWKWARD], items


def benchmark(spark, items):
    return spark.createDataFrame([(*item, "x", "y") for item in items], "item_id long, text string, window string, words string")


def result(frame):
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert frame.columns == names
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("seed, block_bytes", [(1, 6 << 20), (2, 6 << 20), (3, 3000), (4, 900), (5, 5)])
def test_against_brute_force(spark, docs, seed, block_bytes):
    rows, items = case(seed)
    if block_bytes < 900:
        items = items[:6]
    found = contaminated_spans(docs(rows), benchmark(spark, items), block_bytes=block_bytes)
    assert result(audited(found)) == expected(rows, items)


@pytest.mark.parametrize("block_bytes", [6 << 20, 60])
def test_spans_point_into_the_original(spark, docs, block_bytes):
    item = "Zürich ist grösser als Bern, aber Genf liegt am See und Basel am Rhein."
    text = f"\U0001f600 Vorher. {item.upper().replace('Ü', 'ü').replace('Ö', 'ö')} Nachher"
    (row,) = contaminated_spans(docs([(1, text)]), benchmark(spark, [(9, item)]), block_bytes=block_bytes).collect()
    (span,) = row["spans"]
    assert words(text[span["begin"] : span["end"]]) == words(item)
    assert (span["first"], span["words"], row["items"]) == (1 + len(words("\U0001f600")), len(words(item)), [9])


def test_nothing(spark, docs, nothing):
    items = benchmark(spark, [(1, "a b c")])
    assert audited(contaminated_spans(nothing, items)).collect() == []
    rows = [(1, "a b c"), (2, None)]
    none = benchmark(spark, [])
    assert result(audited(contaminated_spans(docs(rows), none))) == expected(rows, [])


def test_repeated_rows_with_several_blocks(spark, docs):
    item = " ".join(f"t{i}" for i in range(60))
    rows = [(1, item), (1, item), (None, item), (1, item + " more"), (2, "clean text")]
    items = [(1, item), (2, item)]
    found = contaminated_spans(docs(rows), benchmark(spark, items), block_bytes=200)
    assert result(audited(found)) == expected(rows, items)
