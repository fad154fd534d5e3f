import hashlib
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from padron.llm import repair

CONV = "conv_id bigint, turn bigint, role string, text string"


def plain_faults(rows):
    """Fault and role of each turn of one conversation in order, from (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else None if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def exhaustive(turns):
    """The least (cost, edits, lines) over every sequence of edits whose cost is within that of deleting all."""
    best = [(3 * len(turns), "D" * len(turns), [])]

    def go(i, cost, audit, lines):
        if cost > best[0][0]:
            return
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or " " for r, _ in lines)):
            best[0] = min(best[0], (cost, audit, lines), key=lambda x: x[:2])
        if i < len(turns):
            role, text, fault = turns[i]
            go(i + 1, cost + 3, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                own = cost + (fault == "truncated")
                go(i + 1, own, audit + "K", [*lines, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, own + 2, audit + "R", [*lines, (new, text)])
        for new in ("user", "assistant"):
            go(i, cost + 2, audit + "I", [*lines, (new, "")])

    go(0, 0, "", [])
    return best[0]


def in_process(turns):
    """The edits of the operator for one conversation."""
    one, found = repair._Repair(), []
    for i, (role, text, fault) in enumerate(turns):
        found += one.add(repair.Turn(i, role, text, fault, False))
    found += one.end()
    return found


def made(rng, n):
    roles = ["user", "assistant"] * 3 + ["system", "tool", "", "User", "underling"]
    texts = ["One.", "Two!", "Three", "Four", "", " \n", "Five?  ", "Six. \x85"]
    return [(rng.choice(roles), rng.choice(texts) + rng.choice(["", "", f" {rng.randint(0, 9)}.", f" {rng.randint(0, 9)}"])) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 512])
def test_repairs_equal_trying_every_edit(block, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_TURNS", block)
    rng = random.Random(block)
    for _ in range(60):
        turns = plain_faults(made(rng, rng.randint(0, 4)))
        cost, audit, lines = exhaustive(turns)
        edits = in_process(turns)
        assert (sum(e.cost for e in edits), "".join(e.edit for e in edits)) == (cost, audit)
        assert [(e.role, e.text) for e in edits if e.edit != "D"] == lines
        assert [e.place for e in edits] == list(range(1, len(edits) + 1))


def test_blocks_change_nothing_and_hold_little(monkeypatch):
    rng = random.Random(5)
    turns = plain_faults([(r, f"{t} {i}{rng.choice(['.', '!', ''])}") for i, (r, t) in enumerate(made(rng, 700))])
    whole = [(e.edit, e.role, e.text) for e in in_process(turns)]  # blocks of 512
    for block in (1, 7, 50):
        monkeypatch.setattr(repair, "BLOCK_TURNS", block)
        assert [(e.edit, e.role, e.text) for e in in_process(turns)] == whole
    one = repair._Repair()
    waiting = []
    for i, (role, text, fault) in enumerate(plain_faults([(["user", "assistant"][i % 2], f"{i}.") for i in range(3000)])):
        list(one.add(repair.Turn(i, role, text, fault, False)))
        waiting.append(len(one.waiting))
    assert max(waiting) <= 100


def brute(rows):
    """The query's columns per conversation, from rows (conv_id, turn, role, text)."""
    out, conversations = {}, {}
    for conv, turn, role, text in rows:
        own = conversations.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = plain_faults([r[1:] for r in own])
        numbers = [r[0] for r in own if r[0] is not None]
        roles = [r[1][:1] for r in own]
        cost, audit, lines = exhaustive(turns)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
        )
    return out


def summed(spark, tmp_path, rows):
    from padron.llm.queries import op12_conversation_repair

    spark.createDataFrame(rows, CONV).withColumn("audit", F.lit("clash")).withColumn("fault", F.lit(1)).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return {r["conv_id"]: tuple(r)[1:] for r in op12_conversation_repair(spark, str(tmp_path)).collect()}


def test_query_equals_trying_every_edit(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        turns = made(rng, rng.randint(1, 4))
        rows += [(conv, rng.choice([i, i, i, i + 2, 1]), *t) for i, t in enumerate(turns)]
    rows += [(None, 0, "user", "a."), (None, None, "assistant", None), (70, None, None, "x"), (70, None, "user", "x"), (71, 3, "user", "Hi."), (71, 3, "user", "Hi.")]
    assert summed(spark, tmp_path, rows) == brute(rows)


def test_long_conversations_long_texts_and_empty_tables(spark, tmp_path):
    rows = [(1, i, ["user", "assistant"][i % 2] if i % 50 else "system", f"turn {i}" + "." * (i % 7 > 0)) for i in range(4000)]
    rows += [(2, 0, "user", "w " * 400_000 + "?"), (2, 1, "assistant", "v" * 300_000)]
    edits = repair.repair(spark.createDataFrame(rows, CONV)).collect()
    for conv in (1, 2):
        own = sorted((r for r in edits if r["conv_id"] == conv), key=lambda r: r["place"])
        turns = plain_faults([r[2:] for r in rows if r[0] == conv])
        whole = [repair.Turn(i, r, t, f, False) for i, (r, t, f) in enumerate(turns)]
        ((cost, audit),) = repair.lightest({repair.START: (0, "")}, whole, goal=True).values()
        assert ("".join(r["edit"] for r in own), sum(r["cost"] for r in own)) == (audit, cost)
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in own if r["edit"] != "D"))
    assert summed(spark, tmp_path, []) == {}


def test_conversations_without_turns_left(spark, tmp_path):
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    assert summed(spark, tmp_path, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
