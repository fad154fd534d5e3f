import random

import duckdb
import pytest
from pyspark.sql import functions as F

from padron.llm import line_dedup as lines
from padron.llm.queries import OP1_SQL


def corpus(seed=1):
    rng = random.Random(seed)
    shared = [[f"shared {g} line {i} {rng.randint(0, 99)}" for i in range(rng.randint(2, 12))] for g in range(6)]
    texts = [None, "", "\n", "\n\n\n", "one line", "one line", "a\nb", "a\nb", "a\nb\n", "  \n \nx\n\t\ny"]
    for i in range(60):
        own = [f"own {i} {j}" for j in range(rng.randint(0, 6))]
        block = rng.choice(shared)
        at = rng.randint(0, len(own))
        if rng.random() < 0.3:
            block = [*block, *block]
        texts.append("\n".join(own[:at] + block + own[at:]))
    texts += [texts[-1], texts[-1]]
    return [(i * 3 % 101 + 1000 * (i // 101), t, "s") for i, t in enumerate(texts)]


def by_sql(docs):
    documents = docs.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    return sorted(con.execute(OP1_SQL).fetchall(), key=str)


def by_spark(docs):
    found = lines.line_dedup(docs).select("doc_id", "text", "n_lines", "n_removed")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_same_as_sql(documents):
    docs = documents(corpus())
    found = by_spark(docs)
    assert found == by_sql(docs) and sum(r[3] for r in found) > 20


def test_equal_hashes_of_unlike_chunks_remove_nothing_wrongly(documents, monkeypatch):
    docs = documents(corpus(2))
    want = by_sql(docs)
    monkeypatch.setattr(lines, "_chunk_hash", lambda chunk: F.length(chunk).cast("bigint") * 0)
    assert by_spark(docs) == want


def test_boundaries_survive_an_inserted_line(documents):
    block = [f"passage {i} of some length" for i in range(40)]
    docs = documents([(1, "\n".join(block), "s"), (2, "\n".join(["new", *block[:20], "inserted", *block[20:]]), "s")])
    removed = {r["doc_id"]: r["n_removed"] for r in lines.line_dedup(docs).collect()}
    assert removed[1] == 0 and removed[2] >= 20


def test_whole_blocks_go_whatever_surrounds_them(documents):
    rng = random.Random(8)
    blocks = [[f"block {b} line {i}" for i in range(n)] for b, n in enumerate([2, 2, 3, 4, 5, 9, 30])]
    texts = ["\n".join(line for b in blocks for line in [f"head {blocks.index(b)}", *b, "foot"])]
    for d in range(40):
        own = [f"own {d} {rng.random()}" for _ in range(rng.randint(0, 3))]
        picked = rng.sample(blocks, rng.randint(1, 3))
        texts.append("\n".join([*own, *(line for b in picked for line in [*b, f"gap {d} {rng.random()}"])]))
    found = {r["doc_id"]: r for r in lines.line_dedup(documents(texts)).collect()}
    assert found[0]["n_removed"] == 0 and found[0]["text"] == texts[0]
    for d in range(1, 41):
        assert not any(line.startswith("block") for line in found[d]["text"].split("\n"))
        assert [line for line in texts[d].split("\n") if not line.startswith("block")] == found[d]["text"].split("\n")


def test_some_copy_of_every_line_stays_and_single_lines_do(documents):
    rng = random.Random(4)
    texts = ["\n".join(rng.choice("abcdefg ") for _ in range(rng.randint(1, 9))) for _ in range(120)]
    found = {r["doc_id"]: r["text"].split("\n") for r in lines.line_dedup(documents(texts)).collect()}
    kept = {line for text in found.values() for line in text}
    assert {line for t in texts for line in t.split("\n")} - {" "} <= kept
    alone = lines.line_dedup(documents([f"same\nown {i}" for i in range(9)])).collect()
    assert all(r["n_removed"] == 0 for r in alone)


def test_very_long_texts(documents):
    long = "\n".join(f"line {i}" for i in range(30_000))
    found = {r["doc_id"]: r for r in lines.line_dedup(documents([long, "x\n" + long, "w" * 300_000])).collect()}
    assert found[1]["text"] == "x" and found[1]["n_removed"] == 30_000 and found[2]["n_removed"] == 0


def test_null_ids_repeated_rows_and_clashing_names(documents):
    text = "\n".join(f"line {i}" for i in range(30))
    docs = documents([(1, text, "s"), (1, text, "s"), (2, text, "s"), (None, text, "s")])
    docs = docs.withColumn("n_removed", F.lit("x")).withColumn("hash", F.lit(1)).withColumn("start", F.lit(2))
    found = sorted(((str(r["doc_id"]), r["n_removed"] > 0) for r in lines.line_dedup(docs).collect()))
    assert found == [("1", False), ("1", False), ("2", True), ("None", False)]


def test_empty_table(documents):
    assert lines.line_dedup(documents([])).collect() == []


@pytest.mark.parametrize("word", ["Python", "Pandas", "Arrow", "MapIn"])
def test_no_python_on_the_main_path(documents, word):
    plan = lines.line_dedup(documents(["a\nb"]))._jdf.queryExecution().toString()
    assert word not in plan
