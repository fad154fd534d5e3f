"""Repair of conversations whose turns were lost, repeated, emptied or given the wrong role.

A good conversation is empty, or pairs of user and assistant turns, with a system turn ahead or not. The cheapest way
there is a lightest derivation: an item says that the first i turns have been edited and the roles so far leave the
grammar in state q; its weight is the cost and the edits' initials. Rules join an item with the next turn kept, given
another role or deleted, or with an inserted turn, and give the weight of the result. Adding to a weight never makes
it smaller, and of two weights of an item the smaller stays smaller whatever is added: neither text of edits can be
the start of the other at equal cost, because only an insertion, which costs, takes no turn. So items leave an agenda
in the order of cost, turns and edits, each is final when it leaves, and the work ends with the goal item.

Long conversations are deduced block by block. The final items of a block (one per state) are the axioms of the next,
and what all of them have in common is settled and handed on, so a task holds a block, never a conversation.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: States of the grammar (s?(ua)+)?: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: State after a turn whose role begins with a letter; a letter that is missing here can't stand there.
STEP = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The role that an inserted or renamed turn takes in a state.
NEEDED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: What any state can at most cost more than any other on the way to the goal: an insertion for the missing role, and
#: the deletion of a system turn that only the start could keep.
LARGEST_GAP = COST[INSERT] + COST[DELETE]
#: A block ends after so many turns or so many characters of text.
BLOCK_TURNS, BLOCK_CHARS = 512, 1 << 20
LEGAL = ("su", "ua", "au")


class Turn(NamedTuple):
    """A turn as it is given, and its first fault: blank, duplicate, truncated or none."""

    turn: int | None
    role: str
    text: str
    fault: str | None
    illegal: bool


class Edit(NamedTuple):
    """One edit of a repair. An inserted turn has no ``turn``, an empty text and no old role."""

    place: int
    edit: str
    cost: int
    turn: int | None
    role_before: str | None
    role: str
    text: str
    fault: str | None
    illegal: bool


def lightest(axioms: dict[int, tuple[int, str]], turns: list[Turn], goal: bool) -> dict[int, tuple[int, str]]:
    """The final weights after all ``turns``, by state: Knuth's agenda from the weights ahead of them.

    ``goal``: the deduction ends with the first item after all turns whose state the grammar accepts, and only that
    one is returned.
    """
    agenda = [(cost, 0, audit, state) for state, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    n = len(turns)
    while agenda:
        cost, i, audit, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n:
            if goal and state in ACCEPTED:
                return {state: (cost, audit)}
            found[state] = (cost, audit)
            if len(found) == len(STEP):
                break
        for edit, extra, at, after in _rules(turns[i] if i < n else None, i, state):
            if (at, after) not in final:
                heapq.heappush(agenda, (cost + extra, at, audit + edit, after))
    return found


def _rules(turn: Turn | None, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """What an item and the next turn give: edit, cost, turns done, state."""
    yield INSERT, COST[INSERT], i, STEP[state][NEEDED[state]]
    if turn is None:
        return
    yield DELETE, COST[DELETE], i + 1, state
    if turn.fault in ("blank", "duplicate"):
        return
    rest = TRUNCATED_COST if turn.fault == "truncated" else 0
    if (kept := STEP[state].get(turn.role[:1])) is not None:
        yield KEEP, COST[KEEP] + rest, i + 1, kept
    yield REROLE, COST[REROLE] + rest, i + 1, STEP[state][NEEDED[state]]


class _Repair:
    """The repair of one conversation as its turns come in order; gives edits as soon as they are settled."""

    def __init__(self):
        self.axioms: dict[int, tuple[int, str]] = {START: (0, "")}
        self.state = START  # where the edits handed on so far end
        self.waiting: list[Turn] = []  # turns whose edits are not settled yet
        self.block: list[Turn] = []
        self.chars = self.place = 0

    def add(self, turn: Turn) -> Iterator[Edit]:
        self.block.append(turn)
        self.chars += len(turn.text) + 1
        if len(self.block) >= BLOCK_TURNS or self.chars >= BLOCK_CHARS:
            yield from self._deduce(goal=False)

    def end(self) -> Iterator[Edit]:
        yield from self._deduce(goal=True)

    def _deduce(self, goal: bool) -> Iterator[Edit]:
        found = lightest(self.axioms, self.block, goal)
        least = min(cost for cost, _ in found.values())
        # What costs more than the gap beyond the least is part of no cheapest repair.
        found = {state: (cost - least, audit) for state, (cost, audit) in found.items() if cost - least <= LARGEST_GAP}
        self.waiting += self.block
        self.block, self.chars = [], 0
        common = os.path.commonprefix([audit for _, audit in found.values()])
        done = 0
        for letter in common:
            yield self._edit(letter, self.waiting[done] if letter != INSERT else None)
            done += letter != INSERT
        del self.waiting[:done]
        self.axioms = {state: (cost, audit[len(common) :]) for state, (cost, audit) in found.items()}

    def _edit(self, letter: str, turn: Turn | None) -> Edit:
        self.place += 1
        needed = NEEDED[self.state]
        if turn is None:
            self.state = STEP[self.state][needed]
            return Edit(self.place, letter, COST[letter], None, None, ROLE[needed], "", None, False)
        cost, role = COST[letter], turn.role
        if letter != DELETE:
            cost += TRUNCATED_COST if turn.fault == "truncated" else 0
            initial = needed if letter == REROLE else turn.role[:1]
            role = ROLE[needed] if letter == REROLE else turn.role
            self.state = STEP[self.state][initial]
        return Edit(self.place, letter, cost, turn.turn, turn.role, role, turn.text, turn.fault, turn.illegal)


# ---- over tables ------------------------------------------------------------------------------------------------


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, fault`` in order: conversations together, by turn (nulls first), role and text.

    Null roles and texts are one space. The first that holds is the fault: ``blank`` (nothing but ASCII white space),
    ``duplicate`` (role and text already in the conversation), ``truncated`` (the last other character is none of
    ``.!?``); else null. One shuffle by conversation; both sorts behind it spill.
    """
    space = r"[\x20\x09-\x0D]"
    plain = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    copy = F.row_number().over(Window.partitionBy("conv_id", "_key").orderBy(F.asc_nulls_first("turn")))
    keyed = plain.repartition("conv_id").withColumn("_key", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(F.col("_copy") > 1, "duplicate")
        .when(~F.col("text").rlike(rf"[.!?]{space}*\z"), "truncated")
    )
    found = keyed.withColumn("_copy", copy).withColumn("fault", fault)
    ordered = found.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "_copy")
    return ordered.drop("_key", "_copy")


EDITS = (
    "place bigint, edit string, cost bigint, turn bigint, role_before string, role string, text string, fault string, illegal boolean"
)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation: ``conv_id`` and one row per edit, in order of ``place``.

    ``edit`` is K (kept), R (another role), D (deleted, the turn as it was) or I (inserted); the rows that are not D are
    the repaired conversation. ``fault`` is the turn's first fault, ``illegal`` says that its role can't follow that of
    the turn before. Of equally cheap repairs it is the one whose edits spell the ASCII-least word. Rows without a
    ``conv_id`` are one conversation. Other columns are not read. Rows of a conversation stay together in order.
    An empty table gives an empty one.

    The turns of one conversation pass through one task, because each edit depends on those before it; the task
    sorts with spilling and holds a block of 512 turns or a megabyte of text and the four states.
    """
    ordered = faults(rows)
    kind = ordered.schema["conv_id"].dataType.simpleString()
    shape = pa.schema(
        [("place", pa.int64()), ("edit", pa.string()), ("cost", pa.int64()), ("turn", pa.int64()), ("role_before", pa.string()),
         ("role", pa.string()), ("text", pa.string()), ("fault", pa.string()), ("illegal", pa.bool_())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Buffer(shape)
        for conv, turns in _conversations(batches, out):
            one, before = _Repair(), None
            for turn, role, text, fault in turns:
                initial = role[:1]
                illegal = before is not None and before + initial not in LEGAL
                before = initial
                yield from out.take(conv, one.add(Turn(turn, role, text, fault, illegal)))
            yield from out.take(conv, one.end())
        yield from out.rest()

    return ordered.mapInArrow(work, f"conv_id {kind}, {EDITS}")


def _conversations(batches: Iterator[pa.RecordBatch], out: _Buffer) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with one ``conv_id``, across batches; each run is read while it is asked for."""
    rows = _rows(batches, out)
    row = next(rows, None)
    while row is not None:
        key, ahead = row[0], [row]

        def run(key=key, ahead=ahead):
            current = ahead.pop()
            while current is not None and current[0] == key:
                yield current[1:]
                current = next(rows, None)
            ahead.append(current)

        yield key, run()
        row = ahead.pop()


def _rows(batches: Iterator[pa.RecordBatch], out: _Buffer) -> Iterator[tuple]:
    for batch in batches:
        out.keys = batch.schema.field(0).type
        for at in range(0, batch.num_rows, BLOCK_TURNS):
            part = batch.slice(at, BLOCK_TURNS)
            yield from zip(*[c.to_pylist() for c in part.columns], strict=True)


class _Buffer:
    """Collects rows and gives them as Arrow batches of bounded size."""

    def __init__(self, shape: pa.Schema):
        self.shape, self.keys = shape, pa.int64()
        self.held: list[tuple] = []
        self.chars = 0

    def take(self, key, rows) -> Iterator[pa.RecordBatch]:
        for r in rows:
            self.held.append((key, *r))
            self.chars += sum(len(x) for x in r if isinstance(x, str))
            if len(self.held) >= 8 * BLOCK_TURNS or self.chars >= 4 * BLOCK_CHARS:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            columns = list(zip(*self.held, strict=True))
            types = [self.keys, *self.shape.types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv_id", *self.shape.names])
        self.held, self.chars = [], 0


SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation from the rows of :func:`repair`, which must come straight from it, in their order.

    ``gaps`` is the largest turn less the least, plus one, less the distinct turns (0 without turns); ``blank``,
    ``duplicate``, ``truncated`` and ``illegal`` count turns; ``cost`` and ``audit`` are the repair's; the digest is
    the SHA-256 of the repaired turns as ``role:text``, joined by line ends. It is taken up as rows pass.
    """
    kind = edits.schema["conv_id"].dataType.simpleString()
    shape = pa.schema([*[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Buffer(shape)
        for conv, rows in _conversations(batches, out):
            first = last = None
            counts = {"blank": 0, "duplicate": 0, "truncated": 0}
            distinct = illegal = cost = 0
            audit, digest, lines = [], hashlib.sha256(), 0
            for _, edit, own, turn, _, role, text, fault, odd in rows:
                if turn is not None and turn != last:
                    distinct += 1
                    first, last = turn if first is None else first, turn
                if fault:
                    counts[fault] += 1
                illegal += odd
                cost += own
                audit.append(edit)
                if edit != DELETE:
                    digest.update(("\n" if lines else "").encode() + f"{role}:{text}".encode())
                    lines += 1
            gaps = last - first + 1 - distinct if distinct else 0
            yield from out.take(conv, [(gaps, *counts.values(), illegal, cost, "".join(audit), digest.hexdigest())])
        yield from out.rest()

    return edits.mapInArrow(work, f"conv_id {kind}, {SUMMARY}")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space throughout.

    0 drops the turn, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 gives it to the user.
    """
    space = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])) % 20
    role: Column = F.when(kind == 4, "user").otherwise(F.coalesce("role", space))
    text = F.coalesce("text", space)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    copies = F.explode(F.array_repeat(F.lit(True), times))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_")).drop("_")
