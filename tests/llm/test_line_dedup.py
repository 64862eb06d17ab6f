import itertools
import random

from conftest_llm import AWKWARD, prose
from wattframe.llm.line_dedup import aligned_blocks, deletions, line_runs, longest_chain, rising_chains, without_common_lines


def line(seed, words=12):
    return " ".join(prose(seed, words))


def result(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_longest_chain_against_brute_force():
    rng = random.Random(1)
    for _ in range(50):
        points = list(enumerate(rng.sample(range(20), 8)))
        chain = [points[i][1] for i in longest_chain(points)]
        assert chain == sorted(chain)
        best = max(
            k for k in range(9) for c in itertools.combinations([v for _, v in points], k) if list(c) == sorted(c)
        )
        assert len(chain) == best
    assert longest_chain([]) == []


def test_later_document_loses_the_common_block(docs):
    passage = [line(i) for i in range(4)]
    first = "\n".join([line(100), *passage, line(101)])
    later = "\n".join([line(200), *passage, line(201)])
    rows = [(9, later), (3, first)]
    assert result(without_common_lines(docs(rows))) == {3: first, 9: f"{line(200)}\n{line(201)}"}


def test_short_lines_and_moved_lines_stay(docs):
    first = "\n".join(["Yes.", line(1), "No.", line(2), "Maybe."])
    chance = "\n".join([line(3), "Yes.", line(4), "No."])
    moved = "\n".join([line(2), line(5), line(1)])  # one alignment holds one of the two, the next the other
    found = result(without_common_lines(docs([(1, first), (2, chance), (3, moved)])))
    assert found[1] == first and found[2] == chance
    assert found[3] == line(5)


def test_copy_with_repeated_lines_and_a_line_known_before(docs):
    repeated = "\n".join([line(1, 4), line(1, 4), line(2, 4), line(1, 4)])
    with_known = "\n".join([line(10, 6), line(20, 6), line(11, 6)])
    rows = [(0, line(20, 6)), (1, repeated), (2, repeated), (3, with_known), (4, with_known)]
    found = result(without_common_lines(docs(rows)))
    assert found[1] == repeated and found[2] == "" and found[3] == with_known
    assert found[4] == ""  # six words alone are no block, but they lie in one that document 3 has


def test_every_line_stays_somewhere(docs):
    rng = random.Random(3)
    rows = [(i, "\n".join(line(rng.randrange(30)) for _ in range(rng.randint(1, 8)))) for i in range(80)]
    before = {x for _, text in rows for x in text.split("\n")}
    found = result(without_common_lines(docs(rows)))
    assert {x for text in found.values() for x in text.split("\n") if x} == before
    for doc_id, text in rows:  # what is left are the document's lines, in order
        lines = iter(text.split("\n"))
        assert all(x in lines for x in found[doc_id].split("\n") if x)


def test_awkward_rows(awkward, nothing):
    found = without_common_lines(awkward)
    assert found.columns == [*awkward.columns, "lines_deleted"]
    assert sorted((repr(r.doc_id), r.text) for r in found.collect() if r.lines_deleted == 0 and r.text) == sorted(
        (repr(i), t) for i, t in AWKWARD if t
    )
    assert found.count() == len(AWKWARD)
    assert without_common_lines(nothing).collect() == []


def test_hot_line(docs):
    hot = line(1, 60)
    rows = [(i, f"{line(1000 + i)}\n{hot}\n{line(5000 + i)}") for i in range(200)]
    found = result(without_common_lines(docs(rows)))
    assert [i for i, text in found.items() if hot in text] == [0]
    assert found[7] == f"{line(1007)}\n{line(5007)}"


def gone_by_brute_force(rows, block_words=10):
    """Numbers of the lines, blank ones aside, in a block that any earlier document has."""
    lines = {doc: [" ".join(x.split()) for x in text.split("\n") if x.split()] for doc, text in rows}
    gone = {doc: set() for doc in lines}
    for doc, here in lines.items():
        for other, there in lines.items():
            if other >= doc:
                continue
            for i in range(len(here)):
                for j in range(len(there)):
                    n = 0
                    while i + n < len(here) and j + n < len(there) and here[i + n] == there[j + n]:
                        n += 1
                    if sum(len(x.split()) for x in here[i : i + n]) >= block_words:
                        gone[doc].update(range(i, i + n))
    return lines, gone


def test_against_brute_force(docs):
    rng = random.Random(11)
    pool = [line(i, rng.choice([1, 2, 3, 5, 8, 12])) for i in range(25)]
    rows = []
    for doc in range(200):
        text = [rng.choice([*pool, "", "  "]) for _ in range(rng.randrange(0, 12))]
        if rows and rng.random() < 0.5:  # a passage of an earlier document, some twice or in another place
            source = rng.choice(rows)[1].split("\n")
            at = rng.randrange(len(source))
            passage = source[at : at + rng.randrange(1, 8)]
            text[rng.randrange(len(text) + 1) :] = passage * rng.choice([1, 1, 2])
        rows.append((doc, "\n".join(text)))
    lines, gone = gone_by_brute_force(rows)
    found = result(without_common_lines(docs(rows)))
    assert sum(map(len, gone.values())) > 200
    for doc in lines:
        left = [" ".join(x.split()) for x in found[doc].split("\n") if x.split()]
        assert left == [x for i, x in enumerate(lines[doc]) if i not in gone[doc]], doc


def test_passage_whose_lines_were_known_one_by_one(docs):
    short = [line(i, 4) for i in range(10)]
    passage = "\n".join(short)
    rows = [*enumerate(short, 1), (20, passage), (21, passage)]
    assert result(without_common_lines(docs(rows))) == {**dict(rows), 21: ""}
    (found,) = deletions(docs(rows)).collect()
    assert found.doc == 21 and [tuple(b)[0] for b in found.blocks] == [20] and found.blocks[0].lines == 10


def test_passage_held_twice(docs):
    passage = [line(i, 6) for i in range(4)]
    later = "\n".join([line(50), *passage, line(51), passage[1], *passage])
    found = result(without_common_lines(docs([(1, "\n".join(passage)), (2, later)])))
    assert found[2] == "\n".join([line(50), line(51), passage[1]])


def test_chains_cover_all_points():
    rng = random.Random(5)
    for _ in range(50):
        points = list(enumerate(rng.choices(range(12), k=10)))
        chains = rising_chains(points)
        assert sorted(i for chain in chains for i in chain) == list(range(10))
        for chain in chains:
            values = [points[i][1] for i in chain]
            assert all(a < b for a, b in zip(values, values[1:]))
        falls = max(
            k for k in range(11) for c in itertools.combinations([v for _, v in points], k)
            if all(a >= b for a, b in zip(c, c[1:]))
        )
        assert len(chains) == falls
    assert rising_chains([]) == [] and aligned_blocks([]) == []


def test_many_repeats_and_turned_lines_in_little_time():
    assert len(aligned_blocks([(i, 0, 1) for i in range(20_000)])) == 20_000
    assert len(aligned_blocks([(i, 20_000 - i, 1) for i in range(20_000)])) == 20_000
    assert aligned_blocks([(i, i + 5, 2) for i in range(20_000)]) == [(0, 5, 20_001)]


def test_runs():
    assert [run[1:] for run in line_runs("a b\n\nc d\ne", 3)] == [(0, 2, 0, 2), (1, 2, 2, 3)]
    assert line_runs("a b", 3) == line_runs("", 3) == line_runs(" \n\t", 1) == []
    assert [run[1:3] for run in line_runs("x " * 12 + "\ny", 10)] == [(0, 1), (0, 2)]


def test_repeated_rows_and_no_identifier(docs):
    passage = line(1, 30)
    rows = [(1, passage)] + [(None, f"{passage}\n{line(2)}")] * 300 + [(4, passage)] * 300
    found = without_common_lines(docs(rows)).groupBy("doc_id", "text").count().collect()
    assert {(r.doc_id, r.text): r["count"] for r in found} == {(1, passage): 1, (None, line(2)): 300, (4, ""): 300}
