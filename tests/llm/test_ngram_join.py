import random

import numpy as np
import pyarrow as pa
import pytest

import wattframe.llm.ngram_join as ngram_join
from conftest_llm import AWKWARD, prose
from wattframe.llm.components import components
from wattframe.llm.ngram_join import linked_components, tree_links


def brute(rows, size=4, percent=85):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        width = min(size, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    ids = [doc_id for doc_id, _ in rows]
    nodes = list(range(len(rows)))

    def find(i):
        while nodes[i] != i:
            i = nodes[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and None not in (ids[i], ids[j]) and 100 * both >= percent * len(sets[i] | sets[j]):
                nodes[find(i)] = find(j)
    groups = {}
    for i, doc_id in enumerate(ids):
        groups.setdefault(find(i), []).append(doc_id)
    smallest = {root: min(members) if None not in members else None for root, members in groups.items()}
    return sorted(((ids[i], len(sets[i]), smallest[find(i)]) for i in range(len(rows))), key=repr)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def family(seed, copies, length, changes):
    """Near copies of one text, each with up to so many changed words."""
    rng = random.Random(seed)
    base = prose(seed, length)
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(length)] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus():
    passage = " ".join(prose(99, 60))
    texts = [t for seed in range(8) for t in family(seed, 5, 60 + 20 * seed, 4)]
    texts += family(50, 70, 120, 5)  # more than a small group
    texts += [passage + " " + " ".join(prose(1000 + i, 40 + i)) for i in range(60)]
    texts += [" ".join(prose(3000 + i, 1 + i % 7, ["a", "b", "c"])) for i in range(30)]
    return list(enumerate(texts))


def test_against_brute_force(docs):
    rows = corpus()
    assert result(linked_components(docs(rows))) == brute(rows)


def test_frequent_grams_and_blocks(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "_frequent", lambda rows: every_second(rows))
    rows = corpus()
    assert result(linked_components(docs(rows))) == brute(rows)


def every_second(rows):
    grams = set()
    for row in rows.collect():
        grams.update(np.frombuffer(row.region, np.int64).tolist())
    return np.array(sorted(grams)[::2], np.int64)


def test_other_shingles(docs):
    rows = corpus()
    assert result(linked_components(docs(rows), 5, 80)) == brute(rows, 5, 80)


def test_awkward_rows(awkward, nothing):
    assert result(linked_components(awkward)) == brute(AWKWARD)
    assert linked_components(nothing).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_tree_finds_what_pairs_find(seed):
    rng = random.Random(seed)
    base = rng.sample(range(500), 60)
    sets = []
    for _ in range(40):
        kept = [g for g in base if rng.random() > rng.choice([0.0, 0.05, 0.3])]
        kept += [rng.randrange(1000, 2000) for _ in range(rng.randint(0, 6))]
        sets.append(np.unique(np.array(kept or [1], np.uint64)))
    found = tree_links([len(s) for s in sets], list(range(40)), sets, 85)

    def groups(pairs):
        nodes = list(range(40))
        for a, b in pairs:
            old, new = nodes[a], nodes[b]
            nodes = [new if n == old else n for n in nodes]
        return {frozenset(i for i in range(40) if nodes[i] == n) for n in nodes}

    linked = [
        (i, j)
        for i in range(40)
        for j in range(i)
        if 185 * len(np.intersect1d(sets[i], sets[j])) >= 85 * (len(sets[i]) + len(sets[j]))
    ]
    assert set(found) <= {(a, b) for a, b in linked} | {(b, a) for a, b in linked}
    assert len(found) <= 39 and groups(found) == groups(linked)


def test_components(spark):
    chain = [(i + 1, i) for i in range(0, 60)] + [(100, 101), (101, 101), (100, 101), (None, 3)]
    edges = spark.createDataFrame(chain, "x long, y long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).collect() == []


def differing(seed, count):
    """Texts of several lengths around shared passages: some linked, some by little, most not."""
    rng = random.Random(seed)
    bases = [prose(seed * 100 + i, 40 + 25 * i) for i in range(4)]
    texts = []
    for i in range(count):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 2, 3, 8])):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        if rng.random() < 0.5:
            words += prose(seed * 1000 + i, rng.randint(1, 25))
        texts.append(" ".join(words[rng.choice([0, 0, 3, 9]) :]))
    return list(enumerate(texts))


@pytest.mark.parametrize("small, seed", [(1, 1), (2, 2), (6, 3)])
def test_groups_of_all_sizes_against_brute_force(docs, monkeypatch, small, seed):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small)
    rows = differing(seed, 90)
    assert result(linked_components(docs(rows))) == brute(rows)
    assert result(linked_components(docs(rows), 3, 60)) == brute(rows, 3, 60)


@pytest.mark.parametrize("small", [2, 32])
def test_sets_only_of_documents_that_can_be_linked(docs, monkeypatch, small):
    """Documents that share a passage of a tenth of their words need no comparing of whole sets."""
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small)
    fetched = []
    sets = ngram_join._sets
    monkeypatch.setattr(ngram_join, "_sets", lambda own, wanted, size: fetched.append(wanted.count()) or sets(own, wanted, size))
    passages = [prose(900 + i, 20) for i in range(12)]
    rows = [(i, " ".join(passages[i % 12] + prose(5000 + i, 180))) for i in range(120)]
    twin = " ".join(rows[0][1].split()[:-2] + ["some", "other"])
    rows.append((500, twin))
    assert result(linked_components(docs(rows))) == brute(rows)
    assert fetched[0] <= 20


@pytest.mark.parametrize("size_x, size_y", [(300, 280), (5000, 4500), (4300, 4000), (0, 10)])
def test_marks_never_hide_common_ngrams(size_x, size_y):
    rng = np.random.default_rng(size_x)
    pool = rng.integers(0, 1 << 62, 6000, dtype=np.uint64)
    for common in (0, min(size_x, size_y) // 2, min(size_x, size_y)):
        sets = [np.unique(np.concatenate([pool[:common], rng.integers(0, 1 << 62, size - common, dtype=np.uint64)])) for size in (size_x, size_y)]
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([x.tobytes() for x in sets])], names=["key", "grams"])
        (found,) = ngram_join._marks(iter([batch]))
        _, n, marks = (column.to_pylist() for column in found.columns)
        most = ngram_join.most_common(n[0], marks[0], n[1], marks[1])
        assert most >= len(np.intersect1d(*sets))
        if size_x == 300:
            assert most <= common + 8


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_whole_sets_only_of_pairs_alike_and_regions_not_shuffled(docs, monkeypatch, broadcast):
    """Pairs with half of their n-grams in common, and those of repeated rows, are told apart before whole sets move."""
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", broadcast)
    passed = []
    alike = ngram_join._alike

    def counted(pairs, sets, percent):
        left = alike(pairs, sets, percent)
        passed.append((pairs.count(), left.count()))
        return left

    monkeypatch.setattr(ngram_join, "_alike", counted)
    rows = []
    for i in range(40):
        base = prose(7000 + i, 160)
        rows += [(10 * i + 1, " ".join(base[:110] + prose(8000 + i, 50))), (10 * i, " ".join(base))]
    rows += [(901, rows[0][1]), (902, rows[0][1]), (903, rows[1][1] + " more")]
    assert result(linked_components(docs(rows))) == brute(rows)
    assert passed[0][0] > passed[0][1] == 1


def test_sets_move_once_for_groups_of_almost_the_same_members(docs, monkeypatch):
    """Near copies that share many n-grams, but are not all linked, do not move for each of these."""
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 8)
    moved = []
    in_trees = ngram_join._in_trees

    def counted(members, sets, percent, across=True):
        if across:
            moved.append((members.count(), members.select("key").distinct().count()))
        return in_trees(members, sets, percent, across)

    monkeypatch.setattr(ngram_join, "_in_trees", counted)
    texts = [t for seed in range(3) for t in family(700 + seed, 14, 300, 12)]
    rows = list(enumerate(texts))
    assert result(linked_components(docs(rows))) == brute(rows)
    ((sent, documents),) = moved
    assert documents > 20 and sent <= 4 * documents


def test_merged_groups_lose_no_pair_and_make_no_more(spark):
    near = [(g, k) for g in range(20) for k in range(100, 140) if (g * 7 + k) % 11]
    unlike = [(50 + g, k) for g in range(6) for k in [*range(200 + 10 * g, 210 + 10 * g), 900]]
    rows = [(g, k, 5 + k, k // 2) for g, k in near + unlike]
    members = spark.createDataFrame(rows, "gram long, key long, n long, component long")
    merged = [tuple(r) for r in ngram_join._merged(members).collect()]

    def pairs(members):
        groups = {}
        for gram, key, *_ in members:
            groups.setdefault(gram, set()).add(key)
        return {(x, y) for keys in groups.values() for x in keys for y in keys}

    assert pairs(rows) <= pairs(merged)
    assert {(k, n, c) for _, k, n, c in merged} == {(k, n, c) for _, k, n, c in rows}
    assert len([r for r in merged if r[0] < 0]) <= 120  # of the 728 of the groups that are alike
    assert sorted(r for r in merged if r[0] >= 0) == sorted(r for r in rows if r[0] >= 50)
    assert ngram_join._merged(members.limit(0)).collect() == []
