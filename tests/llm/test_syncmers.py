import hashlib

from conftest_llm import AWKWARD, prose
from wattframe.llm.syncmers import anchors, edited, fingerprint, fingerprints, likeness


def test_anchor_is_chosen_by_its_own_text():
    text = " ".join(prose(1, 400))
    at, hashes = anchors(text)
    inside = {(int(i), int(h)) for i, h in zip(at, hashes)}
    part, part_hashes = anchors(text[100:900])
    for i, h in zip(part, part_hashes):
        assert (int(i) + 100, int(h)) in inside
    assert len(part) == sum(100 <= i <= 900 - 12 for i, _ in inside)


def test_smallest_inner_string_is_at_an_edge():
    text = " ".join(prose(2, 60))
    at, _ = anchors(text, 12, 12)  # one inner string: every k-mer is chosen
    assert len(at) == len(text) - 11
    at, _ = anchors(text)
    assert 0.15 < len(at) / len(text) < 0.4


def test_likeness():
    one, other = " ".join(prose(3, 500)), " ".join(prose(4, 500))
    assert likeness(fingerprint(one), fingerprint(one)) == 1
    assert likeness("", "") == 1 and likeness(fingerprint(one), "") == 0
    assert likeness(fingerprint(one), fingerprint(other)) < 0.1
    half = edited(one, other)
    assert 0.2 < likeness(fingerprint(one), fingerprint(half)) < 0.5  # a half in common: a third


def test_rows_follow_each_other(spark, awkward):
    order = sorted(AWKWARD, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    expected = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        other = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        expected.append((doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), fingerprint(text), fingerprint(other)))
    for partitions in ("1", "3", "50"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found = fingerprints(awkward).collect()
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert sorted(map(repr, expected)) == sorted(repr(tuple(r[:5])) for r in found)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_single_and_no_rows(docs, nothing):
    (row,) = fingerprints(docs([(5, "abcdefgh")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdabcd").hexdigest() and row.near_next == 1
    assert fingerprints(nothing).collect() == []
