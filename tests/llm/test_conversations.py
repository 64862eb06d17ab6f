import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wattframe.llm import conversations
from wattframe.llm.conversations import Conversation, damaged, repaired

DDL = "conv_id long, turn long, role string, text string, said string, known boolean, kind int, times long"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACES = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", True, 3, 7) for row in rows], DDL)


def plain_damage(rows):
    """The rows after damage by conversation, written down once more from the rules."""
    left = {}
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if value is None else value for value in (role, text))
        kept = left.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    for kept in left.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return left


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        if not end:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found, inserts=4):
    """All edit sequences with at most ``inserts`` insertions, tried one by one."""
    best = None

    def go(i, cost, audit, lines, initials, left):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, lines)
        if left:
            for role in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*lines, f"{role}:"], initials + role[0], left - 1)
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, cost + 3, audit + "D", lines, initials, left)
            if found[i] in (None, "truncated"):
                extra = found[i] is not None
                if role:
                    go(i + 1, cost + extra, audit + "K", [*lines, f"{role}:{text}"], initials + role[0], left)
                for to in ("user", "assistant"):
                    go(i + 1, cost + 2 + extra, audit + "R", [*lines, f"{to}:{text}"], initials + to[0], left)

    go(0, 0, "", [], "", inserts)
    return best


def expected(rows):
    out = []
    for conv, kept in plain_damage(rows).items():
        found = faults(kept)
        turns = [turn for turn, _, _ in kept if turn is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, lines = cheapest(kept, found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [found.count(name) for name in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def result(table):
    return sorted((tuple(row[name] for name in NAMES) for row in table.collect()), key=repr)


def conversation(rng, conv, size):
    texts = ["Yes.", "No!", "Why?", "and then", "", " \n", "Yes. \t", "ends.é", "ok…"]
    roles = ["user", "assistant", "system", "tool", None, ""]
    weights = [8, 8, 2, 1, 1, 1]
    turn = 0
    for _ in range(size):
        turn += rng.choice([0, 1, 1, 1, 3])
        yield (
            conv,
            rng.choice([turn] * 9 + [None]),
            rng.choices(roles, weights)[0],
            rng.choice([*texts, None, *(f"text {rng.random()}." for _ in range(9))]),
        )


def test_against_all_edit_sequences(spark):
    rng = random.Random(12)
    rows = [row for conv in range(150) for row in conversation(rng, conv, rng.randrange(1, 6))]
    rows += [(None, 1, "user", "no id."), (None, None, None, None), (None, 2, "assistant", "fine.")]
    rng.shuffle(rows)
    found = repaired(damaged(frame(spark, rows)))
    assert found.columns == NAMES
    assert result(found) == expected(rows)


def test_ties_take_the_least_audit(spark):
    def audit(*roles):
        rows = [(1, i, role, f"{i}.") for i, role in enumerate(roles)]
        (row,) = repaired(frame(spark, rows).withColumn("dropped", F.lit(False))).collect()
        return row.cost, row.audit

    assert audit("user", "assistant") == (0, "KK")
    assert audit("assistant") == (2, "IK")
    assert audit("user") == (2, "KI")
    assert audit("system", "user") == (2, "KKI")
    assert audit("user", "user") == (2, "KR")  # and not KIKI, RK or KRII
    assert audit("system") == (3, "D")
    assert audit("tool", "tool") == (4, "RR")


def test_conversation_without_rows(spark):
    rows = [(7, turn, "user", "Hi.") for turn in range(2000) if zlib.crc32(f"7:{turn}".encode()) % 20 == 0]
    assert rows
    empty = hashlib.sha256().hexdigest()
    assert result(repaired(damaged(frame(spark, rows)))) == [(7, 0, 0, 0, 0, 0, 0, "", empty)]


def test_nothing(spark):
    assert repaired(damaged(frame(spark, []))).collect() == []


def test_repeated_rows_of_a_turn_are_duplicates(spark):
    rows = [(1, 5, "user", "Same.")] * 4 + [(1, 6, "assistant", "Other."), (1, 9, "user", "Same.")]
    (row,) = repaired(frame(spark, rows).withColumn("dropped", F.lit(False))).collect()
    assert (row.duplicate, row.audit, row.gaps) == (4, "KDDDKD", 2)


@pytest.mark.parametrize("segment", [1, 2, 3, 7])
def test_segments_do_not_change_the_repair(monkeypatch, segment):
    rng = random.Random(segment)
    for _ in range(60):
        rows = list(conversation(rng, 1, 40))
        results = []
        for size in (1000, segment):
            monkeypatch.setattr(conversations, "SEGMENT", size)
            one = Conversation(1)
            for _, turn, role, text in rows:
                one.add(turn, (role or " ").encode(), (text or " ").encode(), False)
            results.append(one.result())
        assert results[0] == results[1]


def test_long_conversation_keeps_only_a_segment(monkeypatch):
    one = Conversation(1)
    for i in range(50_000):
        one.add(i, b"user" if i % 2 == 0 else b"assistant", b"%d." % i, False)
        assert len(one.rows) < conversations.SEGMENT
    assert max(len(item.audit) for item in one.items.values()) <= conversations.SEGMENT
    assert one.result()["audit"] == "K" * 50_000


def test_very_long_text(spark):
    text = "w " * 300_000 + "end."
    rows = [(1, 0, "user", text), (1, 1, "assistant", "Ok.")]
    (row,) = repaired(frame(spark, rows).withColumn("dropped", F.lit(False))).collect()
    assert row.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:Ok.".encode()).hexdigest()
