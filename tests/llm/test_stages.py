"""Stages of the pipeline on rows that repeat, lack something, or are none."""

from conftest_llm import AWKWARD, prose
from wattframe.llm import stages


def grams(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(rows):
    """Numbers of the group of each row with words, by trying all pairs."""
    at = list(range(len(rows)))
    sets = [grams(text or "") for _, text, *_ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if None in (rows[i][0], rows[j][0]) or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and at[i] != at[j]:
                at = [at[j] if x == at[i] else x for x in at]
    return at


def test_near_duplicates_by_identifier_and_text(spark, docs):
    a, b, c = (prose(seed, 60) for seed in (1, 2, 3))
    near = " ".join([*a[:-1], "other"])
    a, b, c = " ".join(a), " ".join(b), " ".join(c)
    rows = [
        (5, a), (7, near), (7, b), (7, b), (7, b), (9, b), (3, c), (3, " ".join([*c.split(), "more"])),
        (8, "x"), (8, "y"), (4, None), (4, ""), (None, a), (None, a),
    ]
    found = stages.near_duplicates(spark, docs(rows), "")
    assert found.columns == stages.COLUMNS
    got = [(r.doc_id, r.text) for r in found.collect()]
    at = groups(rows)
    able = [i for i, (doc, text) in enumerate(rows) if doc is not None and text]
    kept = [x for x in got if x[0] is not None and x[1]]
    assert len(kept) == len({at[i] for i in able})  # one of each group
    for group in {at[i] for i in able}:
        members = [rows[i] for i in able if at[i] == group]
        (stays,) = [x for x in kept if x in members]
        assert stays[0] == min(doc for doc, _ in members)
    rest = sorted((x for x in got if x not in kept), key=repr)
    assert rest == sorted([(4, None), (4, ""), (None, a), (None, a)], key=repr)


def test_line_dedup_stage(spark, docs):
    passage = " ".join(prose(1, 30))
    rows = [(1, passage), (2, f"{passage}\nown"), (3, passage), (4, None), (5, ""), (2, f"{passage}\nown")]
    found = stages.line_dedup(spark, docs(rows), "").collect()
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in found), key=repr) == sorted(
        [(1, passage, len(passage)), (2, "own", 3), (2, "own", 3), (4, None, 0), (5, "", 0)], key=repr
    )


def test_awkward_rows_and_none(spark, awkward, nothing):
    for stage in (stages.line_dedup, stages.near_duplicates):
        assert stage(spark, nothing, "").collect() == []
        assert stage(spark, awkward, "").columns == stages.COLUMNS
    kept = stages.near_duplicates(spark, awkward, "").collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and len(kept) < len(AWKWARD)
