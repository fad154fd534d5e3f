import random
import re

import numpy as np
from pyspark.sql import functions as F

from padron.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside))


def texts(n=300):
    rng = random.Random(4)
    out = [None, "", " \t\n\x0b\x0c\r", "a\x85b\xa0c d", "x " * 40, "l\nl\nl\n \n \nm", "éàü 的 😀", "a b c a b c a b"]
    for i in range(n):
        kind = i % 8
        words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(40, 160))]
        if kind == 0:
            words = [w + rng.choice(["%%%", "***"]) for w in words]
        elif kind == 1:
            words = [w.upper() + "!!" for w in words]
        elif kind == 2:
            words = words[:5] * 20
        out.append("\n".join(" ".join(words[j : j + 12]) for j in range(0, len(words), 12)))
    return out


def test_counts_are_those_of_the_whole_text(documents):
    own = texts(80)
    found = rules.statistics(documents(own)).collect()
    for r in found:
        assert tuple(r[c] for c in rules.COUNTS) == brute(own[r["doc_id"]])


def test_unusual_documents_go_and_clean_ones_stay(documents, labels):
    own = texts()
    docs = documents(own).withColumn("anomaly", F.lit("clash"))
    known = labels([(i, int((i - 8) % 8 > 2), 0) for i in range(8, len(own)) if i % 3] + [(None, 1, 0), (9, None, 0)])
    found = {r["doc_id"]: r for r in rules.judge(docs, known).collect()}
    assert len(found) == len(own)
    for i, r in found.items():
        n, _, _, _, again = brute(own[i])
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
        assert not (r["base_failed"] and r["kept"])
    clean = [found[i] for i in range(8, len(own)) if (i - 8) % 8 > 2 and not found[i]["base_failed"]]
    junk = [found[i] for i in range(8, len(own)) if (i - 8) % 8 < 2]
    assert sum(r["kept"] for r in clean) >= 0.85 * len(clean)
    assert sum(not r["kept"] for r in junk) >= 0.95 * len(junk)


def test_reruns_agree_and_small_tables(documents, labels):
    docs = documents(texts(60))
    none = labels([])
    assert sorted(map(str, rules.judge(docs, none).collect())) == sorted(map(str, rules.judge(docs.repartition(5), none).collect()))
    assert rules.judge(documents([]), none).collect() == []
    assert [r["kept"] for r in rules.judge(documents([None, (None, "a", "s")]), none).collect()] == [False, False]


def test_repeats_count_as_unusual(documents, labels):
    rng = random.Random(9)

    def page(again):
        lines = [" ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(9)) for _ in range(20)]
        return "\n".join([*lines, *([lines[0]] * again)])

    own = [page(0) for _ in range(190)] + [page(12) for _ in range(10)]
    found = {r["doc_id"]: r for r in rules.judge(documents(own), labels([(i, int(i < 190), 0) for i in range(200)])).collect()}
    assert not any(found[i]["base_failed"] for i in range(200))
    assert min(found[i]["anomaly"] for i in range(190, 200)) > np.median([found[i]["anomaly"] for i in range(190)])
    assert sum(not found[i]["kept"] for i in range(190, 200)) >= 8 and sum(found[i]["kept"] for i in range(190)) >= 150


def test_each_tree_has_rows_of_its_own():
    points = np.arange(40, dtype=float).reshape(-1, 1)
    forest = rules.Forest(points, trees=4, rows=10)
    assert all(10 * t <= forest.cut[t, 0] < 10 * t + 10 for t in range(4))
    small = rules.Forest(points[:7], trees=4, rows=10)
    assert small.rows == 7 and (small.scores(points[:7]) > 0).all()


def test_very_long_texts(documents):
    long = " ".join(random.Random(1).choices(["ab", "c", "d#"], k=200_000))
    assert tuple(rules.statistics(documents([long])).first()[c] for c in rules.COUNTS)[:3] == (200_000, len(long) - 199_999, long.count("#"))
