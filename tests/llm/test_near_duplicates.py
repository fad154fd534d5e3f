import random
import re

import pytest
from pyspark.sql import functions as F

from padron.llm import near_duplicates as near
from padron.llm.components import components


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def union(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(texts, width, percent=80):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    groups = union(ids, links)
    return {i: (len(sets[i]), groups[i], groups[i] == i) for i in ids}


def corpus(seed, groups=12, copies=8, edits=6):
    rng = random.Random(seed)
    texts = ["", None, "one two", "ONE two", "one two three", "\t\n", "É x y z q", "é x y z q"]
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 120))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"e{rng.randint(0, 9999)}"
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("width", [4, 5])
def test_components_are_those_of_all_pairs(documents, width):
    texts = corpus(width)
    found = near.near_duplicates(documents([(i, t, "s") for i, t in texts.items()]), width=width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute(texts, width)


@pytest.mark.parametrize("rounds", [1, 3])
def test_the_prefix_filter_finds_what_the_leaders_miss(documents, monkeypatch, rounds):
    # All share a bucket in every band, though many pairs are not similar: every signature is the same.
    texts = corpus(9, groups=6, copies=5)
    docs = documents([(i, t, "s") for i, t in texts.items()])
    rows = near._signatures

    def constant(batches, width):
        import pyarrow as pa

        for b in rows(batches, width):
            same = pa.array([None if n == 0 else b"\x01\x00" * 240 for n in b.column(1).to_pylist()], pa.binary())
            yield b.set_column(4, "signature", same)

    monkeypatch.setattr(near, "_signatures", constant)
    monkeypatch.setattr(near, "ROUNDS", rounds)
    found = near.near_duplicates(docs, width=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: v[1] for i, v in brute(texts, 4).items()}


def test_nulls_repeated_rows_and_other_columns(documents):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents([(5, text, "s"), (5, text, "s"), (3, text.upper(), "t"), (None, text, "s"), (None, None, "s"), (9, "a b c", "s")])
    found = near.near_duplicates(docs.withColumn("component_id", F.lit("x")).withColumn("node", F.lit(1)))
    rows = [(str(r["doc_id"]), r["component_id"], r["kept"]) for r in found.collect()]
    assert sorted(rows, key=str) == [
        ("3", 3, True), ("5", 3, False), ("5", 3, False), ("9", 9, True), ("None", 3, True), ("None", None, True),
    ]
    assert near.near_duplicates(documents([])).collect() == []


def test_prefixes_of_similar_sets_meet():
    rng = random.Random(6)
    for _ in range(400):
        n = rng.randint(1, 60)
        one = set(rng.sample(range(200), n))
        two = set(one)
        for _ in range(rng.randint(0, 12)):
            two.discard(rng.choice(sorted(two)) if len(two) > 1 else None)
            two.add(rng.randint(0, 400))
        for percent in (50, 80, 95):
            if 100 * len(one & two) >= percent * len(one | two):
                a, b = (set(sorted(x)[: near.prefix_length(len(x), percent)]) for x in (one, two))
                assert a & b
                assert 100 * len(one) >= percent * len(two) and 100 * len(two) >= percent * len(one)


def test_pruning_keeps_pairs_at_the_threshold():
    least = near.least_agreements(240, 80)
    assert len(least) == 10 and all(a < b for a, b in zip(least, least[1:], strict=False))
    assert least[-1] < 0.8 * 240 - 4 * (240 * 0.16) ** 0.5


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert found == union(nodes, edges if all(a in nodes and b in nodes for a, b in edges) else [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
