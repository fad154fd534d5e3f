import math
import re

import pytest
from pyspark.sql import functions as F

from padron.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def rows_of(n, source, words):
    return [(hash((source, i)) % 10**9, " ".join(["w"] * words(i)), source) for i in range(n)]


@pytest.fixture
def docs(documents):
    rows = (
        rows_of(400, "é-hot", lambda i: 5 + i % 40) + rows_of(30, "A", lambda i: 3) + rows_of(60, "b", lambda i: 1 + i)
        + rows_of(20, None, lambda i: i) + [(1, None, "A"), (2, "", "b"), (3, "", "void"), (4, "x y", "A"), (4, "x y", "A"), (None, "a b", "b")]
    )
    return documents(rows).withColumn("target", F.lit("clash"))


def test_targets_rates_and_copies(docs):
    rows = mixing.mix(docs).collect()
    sizes = {}
    for r in rows:
        assert r["size"] == size(r["text"]) and 0 <= r["copies"] <= 3 and r["taken"] == r["size"] * r["copies"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    assert len(rows) == docs.count()
    want = brute_targets(sizes)
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9) for r in own)
        assert math.isclose(sum(r["size"] * r["rate"] for r in own), want[s], rel_tol=1e-4, abs_tol=1e-6)
        largest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(largest, 0.02 * want[s])


def test_rates_tilt_exponentially_in_the_size(docs):
    rows = [r for r in mixing.mix(docs).collect() if r["source"] == "é-hot" and 0 < r["rate"] < 3]
    slopes = [math.log(r["rate"]) / r["size"] for r in rows]
    assert max(slopes) - min(slopes) < 1e-5


def test_reruns_agree_whatever_the_partitions(docs):
    def key(df):
        return sorted((str(r["doc_id"]), r["text"] or "", r["taken"]) for r in mixing.mix(df).collect())

    assert key(docs) == key(docs.repartition(7))


def test_repeat_and_empty(docs, documents):
    mixed = mixing.mix(docs)
    assert mixing.repeat(mixed, ["doc_id", "text"]).count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(documents([])).collect() == []
    assert [r["taken"] for r in mixing.mix(documents([None, ""])).collect()] == [0, 0]
