import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from padron.llm import interactions

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def figures(text):
    text = text or ""
    words = WORD.findall(text)
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


def failing(rows):
    """The failed filters of each (doc_id, text, source) as a set of letters."""
    out = []
    for key, text, _ in rows:
        n, distinct, capitals, points, symbols = figures(text)
        bad = {"A"} if n < 50 else set()
        bad |= {"B"} if 100 * distinct < 65 * n else set()
        bad |= {"C"} if 100 * capitals > 5 * points else set()
        bad |= {"D"} if symbols else set()
        same = [k for k, t, _ in rows if (t or "") == (text or "") and k is not None]
        bad |= {"E"} if key is not None and any(k < key for k in same) else set()
        out.append(bad)
    return out


def brute(rows, labels):
    """Every order applied document by document."""
    good = {k for k, q, _ in labels if q == 1} - {None}
    toxic = {k for k, _, t in labels if t == 1} - {None}
    bad, found = failing(rows), {}
    for part in {s or "" for _, _, s in rows}:
        own = [(rows[i][0], bad[i]) for i in range(len(rows)) if (rows[i][2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f,
                ]
        for key, row in found.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in found.items()}


def made(n=60):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        words = [rng.choice(["the", "Étion", "x#y", "WORD", "a|b", "的", "ü", "q" * 9]) + rng.choice(["", str(rng.randint(0, 400))]) for _ in range(rng.choice([3, 49, 50, 51, 90]))]
        rows.append((i, " ".join(w for w in words if rng.random() < 0.7 or "#" not in w), rng.choice(["s0", "s0", "s1", None, ""])))
    rows += [(100 + i, rows[i % 3][1], "s0") for i in range(20)]
    return rows + [(200, None, "s1"), (201, "", "s0"), (202, " \t", None), (None, rows[0][1], "s1"), (None, None, "s2"), (7, rows[7][1], "s1"), (0, "other", "s0")]


def test_transducer_and_words_equal_plain_counting(documents):
    odd = [None, "", " \t\n\x0b\x0c\r", "a\x85b\xa0c d", "É" * 70 + " " + "É" * 70 + " " + "É" * 69 + "È", "A A a aa AA", "😀😀 😀 #$%&*|", "x" * 8 + " " + "x" * 9 + " " + "x" * 8]
    long = " ".join(random.Random(1).choices(["ab", "Ab", "äb", "z" * 100, "z" * 99 + "y"], k=300_000))
    texts = [*odd, long, *[t for _, t, _ in made()]]
    found = {r["doc_id"]: r for r in interactions.measure(documents(texts).select("doc_id", "lang", "text")).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert tuple(found[i][c] for c in interactions.FIGURES) == figures(text), (text or "")[:40]
        assert found[i]["lang"] == "en"
    assert found[0]["digest"] == found[1]["digest"] != found[2]["digest"]


def test_words_of_one_hash_are_told_apart():
    flat = np.frombuffer(b"ab cd ab ef cd " + b"g" * 80 + b" " + b"h" * 80 + b" " + b"g" * 80, np.uint8)
    noted = interactions.transduce(flat, np.array([0, len(flat)]))
    starts, ends = np.flatnonzero(noted & interactions.BEGIN), np.flatnonzero(noted & interactions.END)
    words = interactions._Words(flat, starts, np.append(ends, len(flat)) - starts)
    rows = np.array([0, 0, 0, 0, 1, 1, 1, 1])
    assert interactions.distinct_words(words, rows, 2, np.zeros(8, np.uint64)).tolist() == [3, 3]


def test_every_order_equals_filtering_one_by_one(spark, documents, labels):
    rows = made()
    known = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 100, 3)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (9, None, None), (100, 1, 1)]
    docs = documents(rows).withColumn("part", F.lit("clash")).withColumn("failed", F.lit(9)).repartition(7)
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in interactions.audit(docs, labels(known)).collect()}
    assert found == brute(rows, known)
    assert len(found) == 600 * 4  # s0, s1, s2 and the empty string


def test_empty_tables_and_clashes(documents, labels):
    assert interactions.audit(documents([]), labels([])).collect() == []
    found = interactions.audit(documents([(1, None, None)]), labels([])).filter("filter_order = 'EDCBA'").orderBy("step").collect()
    assert [tuple(r) for r in found][0] == ("", "EDCBA", 1, 1, 0, 0, 0, 0, 0, 0)
    assert found[4]["removed"] == 1 and found[4]["shapley"] == 120 and found[4]["unique_fails"] == 1
    with pytest.raises(ValueError, match="n_words"):
        interactions.measure(documents(["a"]).withColumn("n_words", F.lit(1)))
