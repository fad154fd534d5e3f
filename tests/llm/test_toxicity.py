import math
import random

import numpy as np
from pyspark.sql import functions as F

from padron.llm import toxicity as tox


def text(rng, toxic):
    words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(20, 90))]
    for _ in range(rng.randint(1, 4) if toxic else 0):
        words.insert(rng.randrange(len(words)), rng.choice(["scoundrel", "Rascal!", "vermin" + rng.choice(["ous", "like", "y"])]))
    return " ".join(words)


def corpus(n=600):
    rng = random.Random(12)
    return [(i, text(rng, i % 7 == 0), "s") for i in range(n)], [(i, 1, int(i % 7 == 0)) for i in range(n)]


def brute_segments(values):
    """All maximal segments by their definition: best stretch first, then the same on either side."""
    if not values or max(values) <= 0:
        return []
    best = max(((round(sum(values[i:j]), 9), -(j - i), -i, i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)))
    i, j = best[3], best[4]
    right = [(a + j, b + j) for a, b in brute_segments(values[j:])]
    return [*brute_segments(values[:i]), (i, j), *right]


def test_segments_are_the_maximal_ones():
    rng = random.Random(3)
    for _ in range(300):
        values = [rng.choice([0, 0, 0, 0.37, 1.13, 2.71]) for _ in range(rng.randint(0, 25))]
        places = [i for i, v in enumerate(values) if v]
        found = tox.segments(places, [values[i] for i in places], drift=0.31)
        full = [v if v else -0.31 for v in values]
        assert [(a, b) for a, b, _ in found] == brute_segments(full)
        assert all(math.isclose(s, sum(full[a:b]), abs_tol=1e-9) for a, b, s in found)


def test_held_out_texts_are_told_apart(documents, labels):
    rows, known = corpus()
    docs, known = documents(rows), labels(known)
    model = tox.fit(docs, known.filter(~tox.held_out(F.col("doc_id"))))
    assert {"scoundrel", "rascal", "vermi*"} <= set(model.scores)
    found = tox.score(docs.withColumn("score", F.lit("clash")), model).join(known, "doc_id").filter(tox.held_out(F.col("doc_id"))).collect()
    assert len(found) > 80
    right = [(r["score"] >= 0.5) == bool(r["toxic"]) for r in found]
    assert np.mean(right) >= 0.97
    for r in found:
        assert 0 <= r["score"] <= 1
        for p in r["passages"]:
            assert p["first_word"] <= p["last_word"] and p["p_value"] <= tox.SIGNIFICANT


def test_only_the_given_labels_matter(documents, labels):
    rows, known = corpus()
    docs = documents(rows)
    open_ = labels(known).filter(~tox.held_out(F.col("doc_id")))
    flipped = labels([(i, q, 1 - t) for i, q, t in known]).filter(tox.held_out(F.col("doc_id")))
    one = tox.fit(docs, open_)
    shuffled = tox.fit(docs.repartition(7).withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")), open_)
    assert one.scores == shuffled.scores and one.table == shuffled.table
    assert tox.fit(docs, open_.unionAll(flipped)).table != one.table


def test_nulls_repeats_and_no_labels(documents, labels):
    rows, known = corpus(200)
    docs = documents([*rows, (0, rows[0][1], "s"), (None, "scoundrel", "s"), (5000, None, "s"), (5001, "", "s")])
    model = tox.fit(docs, labels([*known, (None, 1, 1), (5000, None, None), (5001, 1, 0), (1, 1, 7)]))
    found = tox.score(docs, model).collect()
    assert len(found) == 204 and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (5000, 5001)}) == 1
    none = tox.fit(docs, labels([]))
    assert {r["score"] for r in tox.score(docs, none).collect()} == {0.0}
    assert tox.score(documents([]), model).collect() == []
    kept = tox.keep(docs.withColumn("extra", F.array(F.lit(1))), model)
    assert kept.columns == [*docs.columns, "extra"] and 0 < kept.count() < 204


def test_rising_shares():
    assert tox.rising(np.array([0, 2, 1, 0, 9.0]), np.array([10, 4, 10, 0, 10.0])) == [0.0, 3 / 14, 3 / 14, 3 / 14, 0.9]


def test_very_long_texts_and_documents_with_two_labels(documents, labels):
    rows, known = corpus(300)
    long = " ".join(random.Random(2).choices([f"w{i}" for i in range(300)], k=150_000))
    docs = documents([*rows, (9000, long, "s"), (9001, long + " scoundrel rascal vermin", "s")])
    model = tox.fit(docs, labels([*known, (1, 1, 1), (1, 1, 0)]))
    assert model.scores == tox.fit(docs, labels([(1, 1, 1), *[k for k in known if k[0] != 1]])).scores
    found = {r["doc_id"]: r for r in tox.score(docs, model).filter("doc_id >= 9000").collect()}
    assert found[9000]["passages"] == [] and found[9001]["passages"][0]["first_word"] >= 149_000
