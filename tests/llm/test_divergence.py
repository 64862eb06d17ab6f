import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattframe.llm.divergence import probability, source_divergence

TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {i: i + 32 for i in range(65, 91)}
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def expected(rows, least=30, top=50):
    rows = [(text or "", lang or "", source or "") for _, text, lang, source in rows]
    counts, documents = {}, {}
    for text, lang, source in rows:
        terms = TERMS.findall(text.translate(UPPER))
        counts.setdefault((lang, source), Counter()).update(terms)
        documents.setdefault(lang, Counter()).update(set(terms))
    out = []
    for (lang, source), here in counts.items():
        kept = {term for term, n in documents[lang].items() if n >= least}
        sources = sorted(s for group, s in counts if group == lang)

        def p(count):
            total = sum(count[term] for term in kept)
            return {term: 1 + (10**9 * (count[term] + 5)) // (total + 5 * len(kept)) for term in kept}

        whole = sum((counts[lang, s] for s in sources), Counter())
        mine, q = p(here), p(whole)
        pairs = []
        for other in sources:
            if other != source:
                theirs = p(counts[lang, other])
                pairs.append((-sum(abs(mine[term] - theirs[term]) for term in kept), other.encode()))
        terms = [(q[term] - mine[term], term.encode()) for term in kept if here[term] and mine[term] > q[term]]
        for part, found in (("pair", pairs), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -v, i) for i, (v, item) in enumerate(sorted(found), 1)]
    return sorted(out)


def result(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(row) for row in frame.collect())


def corpus(seed, n=400, vocabulary=300):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(vocabulary)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, "xx"])
        source = rng.choice(["a"] * 6 + ["b", "é", "ab", "", None, "z9"])
        size = rng.choice([0, 3, 30, 120])
        text = " ".join(rng.choice(words[: int(2 + rng.random() ** 2 * (vocabulary - 2))]) for _ in range(size))
        rows.append((i, rng.choice([text, text.upper(), text.replace(" ", "1-")]), lang, source))
    return rows


@pytest.mark.parametrize("seed, least, top", [(1, 30, 50), (2, 3, 5), (3, 1, 50), (4, 1000, 50)])
def test_against_plain_sums(docs, seed, least, top):
    rows = corpus(seed)
    rows += [(None, None, None, None), (5, None, "only", "one"), (6, "word " * 20_000, "en", "long"), *rows[:20]]
    rows += [(7, "same two", "tie", s) for s in "abc"]
    assert result(source_divergence(docs(rows), least, top)) == expected(rows, least, top)


def test_hot_source_over_many_partitions(docs):
    rows = [(i, f"common w{chr(97 + i % 7)}x", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    found = source_divergence(docs(rows).repartition(16))
    assert result(found) == expected(rows)


def test_nothing(nothing):
    assert source_divergence(nothing).collect() == []


def test_probability_of_counts_beyond_64_bits(spark):
    n, total, terms = 10**13, 3 * 10**17, 10**9
    row = spark.range(1).select(probability(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + (10**9 * (n + 5)) // (total + 5 * terms)
