"""Repair of damaged conversations as a lightest derivation.

A conversation is well formed if its roles' initials are ``(s?(ua)+)?``: nothing, or an optional system
turn and pairs of user and assistant. A repair keeps, reroles or deletes each row and inserts empty
turns. An item ``(i, state)`` says that the first ``i`` rows are repaired to a sequence that ends in
``state``; each edit is a deduction from one item to the next, and Knuth's agenda takes the lightest
item first, so every item is final once it is popped. Weights are ``(cost, audit)``, the audit being
the edits' initials. Two audits of one item with equal cost are never prefixes of each other (each has
one letter per row, and trailing insertions cost), so their order outlasts every continuation:
the deductions are monotone. A free Keep does not raise the cost, but it moves on by a row; the
agenda's order is ``(cost, i, audit)``, which every deduction raises.

Rows of a conversation are sorted and stream through one task, ``SEGMENT`` rows at a time: the final
items of a segment are the axioms of the next. What all of them agree on is handed on, so a task
holds a segment and the audits, whatever a conversation's length. The digest of the repaired text is one
SHA-256 over the conversation and therefore sequential in any design.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices
from wattframe.session import keep

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits; a truncated row that stays adds one.
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: Rows whose items are on the agenda at the same time.
SEGMENT = 512

#: States: nothing yet, or the last role's initial. The one role that each state can be followed by
#: (a system turn opens a conversation only, and is never made).
START = ""
FOLLOWS = {START: "u", "s": "u", "u": "a", "a": "u"}
ROLES = {"u": b"user", "a": b"assistant"}
GOALS = (START, "a")
LEGAL = {"su", "ua", "au"}

_SPACE = b" \t\n\x0b\x0c\r"
_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def fault(text: bytes, seen: bool) -> str | None:
    """A row's first fault."""
    end = text.rstrip(_SPACE)
    if not end:
        return "blank"
    if seen:
        return "duplicate"
    return None if end[-1:] in (b".", b"!", b"?") else "truncated"


class Item:
    """A final item: its weight, the item of the segment's start it came from, and its text so far."""

    __slots__ = ("cost", "audit", "origin", "digest", "begun")

    def __init__(self, cost, audit, origin=None, digest=None, begun=False):
        self.cost, self.audit, self.origin, self.digest, self.begun = cost, audit, origin, digest, begun


def agenda(axioms: dict[str, Item], rows: list[tuple[str, str | None]]) -> dict[str, Item]:
    """The lightest items after ``rows`` by state; ``rows`` are ``(role's initial, fault)``."""
    n = len(rows)
    final: set[tuple[int, str]] = set()
    heap = [(item.cost, 0, item.audit, state, state) for state, item in axioms.items()]
    heapq.heapify(heap)
    ends: dict[str, Item] = {}
    push, pop = heapq.heappush, heapq.heappop
    insert, delete, rerole = COSTS[INSERT], COSTS[DELETE], COSTS[REROLE]
    while heap:
        cost, i, audit, state, origin = pop(heap)
        if (i, state) in final:
            continue
        final.add((i, state))
        following = FOLLOWS[state]
        if (i, following) not in final:
            push(heap, (cost + insert, i, audit + INSERT, following, origin))
        if i == n:
            ends[state] = Item(cost, audit, origin)
            if len(ends) == len(FOLLOWS):
                break
            continue
        initial, bad = rows[i]
        push(heap, (cost + delete, i + 1, audit + DELETE, state, origin))
        if bad is None or bad == "truncated":
            stays = cost + (TRUNCATED_COST if bad else 0)
            if initial == following or (initial == "s" and state == START):
                push(heap, (stays, i + 1, audit + KEEP, initial, origin))
            push(heap, (stays + rerole, i + 1, audit + REROLE, following, origin))
    return ends


def without_hopeless(ends: dict[str, Item]) -> dict[str, Item]:
    """The items that can still be part of a lightest derivation.

    After an assistant all goes on as it does from the start or from a system turn, but for a system
    turn that only the start can keep, and that can be deleted instead.
    """
    bound = ends["a"].cost
    spare = {START: COSTS[DELETE], "s": 0}
    return {state: item for state, item in ends.items() if item.cost <= bound + spare.get(state, item.cost)}


def _write(item: Item, role: bytes, text: bytes) -> None:
    item.digest.update((b"\n" if item.begun else b"") + role + b":" + text)
    item.begun = True


def replay(start: Item, end: Item, state: str, edits: str, rows: list[tuple[bytes, bytes, str]]) -> None:
    """Carry the repaired text on from ``start`` through ``edits``; ``rows`` are ``(role, text, initial)``."""
    end.digest, end.begun = start.digest.copy(), start.begun
    at = 0
    for edit in edits:
        if edit == INSERT:
            state = FOLLOWS[state]
            _write(end, ROLES[state], b"")
            continue
        role, text, initial = rows[at]
        at += 1
        if edit == KEEP:
            state = initial
            _write(end, role, text)
        elif edit == REROLE:
            state = FOLLOWS[state]
            _write(end, ROLES[state], text)


class Conversation:
    """The rows of one conversation in order, repaired a segment at a time."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.items = {START: Item(0, "", digest=hashlib.sha256())}
        self.settled: list[str] = []
        self.rows: list[tuple[bytes, bytes, str]] = []
        self.faults: list[tuple[str, str | None]] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first_turn = self.last_turn = self.before = None
        self.turns = 0

    def add(self, turn: int | None, role: bytes, text: bytes, known: bool) -> None:
        """The next row; ``known`` says that an earlier turn has its role and text."""
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        bad = fault(text, known or self.before == (turn, role, text))
        initial = role.decode("utf-8", "replace")[:1]
        if self.before is not None:
            self.counts["illegal"] += self.before[1].decode("utf-8", "replace")[:1] + initial not in LEGAL
        if bad:
            self.counts[bad] += 1
        self.before = (turn, role, text)
        self.rows.append((role, text, initial))
        self.faults.append((initial, bad))
        if len(self.rows) == SEGMENT:
            self.close_segment()

    def close_segment(self) -> None:
        ends = without_hopeless(agenda(self.items, self.faults))
        for end in ends.values():
            start = self.items[end.origin]
            replay(start, end, end.origin, end.audit[len(start.audit) :], self.rows)
        agreed = _common_prefix([end.audit for end in ends.values()])
        self.settled.append(next(iter(ends.values())).audit[:agreed])
        for end in ends.values():
            end.audit = end.audit[agreed:]
        self.items, self.rows, self.faults = ends, [], []

    def result(self) -> dict:
        self.close_segment()
        _, best = min(
            ((item.cost, item.audit), state) for state, item in self.items.items() if state in GOALS
        )
        goal = self.items[best]
        span = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {
            "conv_id": self.conv_id,
            "gaps": span,
            **self.counts,
            "cost": goal.cost,
            "audit": "".join([*self.settled, goal.audit]),
            "repaired_sha256": goal.digest.hexdigest(),
        }


def _common_prefix(texts: list[str]) -> int:
    low, high = min(texts), max(texts)
    for i, (a, b) in enumerate(zip(low, high)):
        if a != b:
            return i
    return min(len(low), len(high))


_SCHEMA = pa.schema(
    [
        (name, pa.string() if name in ("audit", "repaired_sha256") else pa.int64())
        for name in (field.split()[0] for field in _RESULT.split(", "))
    ]
)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn to one result per conversation."""
    current: Conversation | None = None
    done: list[dict] = []
    for batch in in_slices(batches):
        for conv_id, dropped, turn, role, text, known in zip(*(column.to_pylist() for column in batch.columns)):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.result())
                current = Conversation(conv_id)
            if not dropped:
                current.add(turn, role, text, known)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, schema=_SCHEMA)
            done = []
    if current is not None:
        done.append(current.result())
    yield pa.RecordBatch.from_pylist(done, schema=_SCHEMA)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped``: rows damaged by ``crc32(conv_id:turn) % 20``.

    0 drops a row (it stays as a mark that its conversation exists), 1 empties its text, 2 takes its
    ``.``, ``!`` and ``?`` away, 3 repeats it, 4 makes its role user. NULLs read as one space.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    conv_id, turn = (F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv_id, F.lit(":"), turn).cast("binary")) % 20
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return (
        rows.withColumn("kind", kind)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind").isin(0, 1), F.lit(""))
            .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            (F.col("kind") == 0).alias("dropped"),
        )
    )


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, and its cheapest repair.

    ``rows`` has ``conv_id, turn, role, text`` and ``dropped``, which marks rows that only say that the
    conversation exists. Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Rows are taken by turn, those without turn first; ties are taken by role and text
    (UTF-8), so that equal rows are adjacent. NULL role and text read as one space; an empty role has no
    initial and cannot be kept; all rows without ``conv_id`` are one conversation. A conversation of dropped rows only has zeros, an empty audit and the
    hash of nothing. Other columns are ignored, so their names cannot clash; no rows in, no rows out.
    """
    space = F.lit(" ")
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.coalesce(F.col("dropped"), F.lit(False)).alias("dropped"),
    )
    # What several rows of a conversation say, with the first turn that says it; counted before rows
    # meet, without their texts. A conversation's number of rows does not matter here.
    said = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    # A dropped row says nothing; it gets a name of its own, so that such rows do not share a key.
    said = F.when(F.col("dropped"), F.coalesce(F.col("turn").cast("string"), F.lit("-"))).otherwise(said)
    marked = rows.withColumn("said", F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), said))
    place = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    repeats = (
        marked.where(~F.col("dropped"))
        .groupBy("said")
        .agg(F.count("*").alias("times"), F.min(place).alias("first_place"))
    )
    repeats = keep(repeats.where("times > 1").select("said", "first_place"))
    known = F.coalesce(F.col("first_place") < place, F.lit(False))
    return (
        marked.join(repeats, "said", "left")
        .select(
            "conv_id",
            "dropped",
            "turn",
            F.col("role").cast("binary").alias("role"),
            F.col("text").cast("binary").alias("text"),
            known.alias("known"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_repaired, _RESULT)
    )
