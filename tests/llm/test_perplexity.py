import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from padron.llm import perplexity as model


def text(rng, junk=False):
    out = []
    for _ in range(rng.randint(20, 80)):
        w = f"w{min(int(rng.expovariate(0.15)), 60)}"
        out.append(w.upper() + "%%%" if junk else w + rng.choice(["", "", ",", "."]))
    return " ".join(out)


def brute(train, words, tests):
    """A plain interpolated modified Kneser-Ney bigram model over ids."""
    ids = model.Ids(words)
    size = len(words) + len(model.SHAPES)
    pairs = Counter()
    for t in train:
        x = ids.of(t).tolist()
        pairs.update(zip(x, x[1:], strict=False))

    def disc(counts):
        n = [max(float(sum(c == k for c in counts)), 1.0) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]

    d2 = disc(pairs.values())
    before = Counter(w for _, w in pairs)
    d1 = disc(before.values())
    total, follow = Counter(), defaultdict(list)
    for (v, _), n in pairs.items():
        total[v] += n
        follow[v].append(n)
    everything = sum(before.values())
    rest = sum(d1[min(n, 3) - 1] for n in before.values()) / everything

    def p1(w):
        n = before[w]
        return max(n - (d1[min(n, 3) - 1] if n else 0), 0) / everything + rest / size

    def p2(v, w):
        if not total[v]:
            return p1(w)
        n = pairs[v, w]
        gamma = sum(d2[min(c, 3) - 1] for c in follow[v]) / total[v]
        return max(n - (d2[min(n, 3) - 1] if n else 0), 0) / total[v] + gamma * p1(w)

    out = []
    for t in tests:
        x = ids.of(t).tolist()
        out.append(sum(math.log(p2(v, w)) for v, w in zip(x, x[1:], strict=False)))
    check = {v: sum(p2(v, w) for w in range(size)) for v in list(total)[:3]}
    return out, check


@pytest.mark.parametrize("frequent", [0, 20])
def test_same_as_a_plain_model(spark, documents, monkeypatch, frequent):
    monkeypatch.setattr(model, "LEAST_SHARDS", 5)
    rng = random.Random(6)
    train = [text(rng) for _ in range(60)] + [None, ""]
    tests = [text(rng, junk=i % 4 == 0) for i in range(40)] + [None, "", "...", "one"]
    fitted = model.train(documents(train), vocabulary=40, frequent=frequent)
    want, sums = brute([t or "" for t in train], fitted.vocabulary, [t or "" for t in tests])
    assert all(math.isclose(x, 1, rel_tol=1e-9) for x in sums.values())
    rows = {r["doc_id"]: r for r in model.score(documents(tests).repartition(3), fitted).collect()}
    assert len(rows) == len(tests)
    ids = model.Ids(fitted.vocabulary, fitted.letters)
    want = [x + ids.read(t or "")[1] for x, t in zip(want, tests, strict=True)]
    for i, x in enumerate(want):
        assert math.isclose(rows[i]["log_prob"], x, rel_tol=1e-5, abs_tol=1e-5)
        assert (rows[i]["perplexity"] is None) == (rows[i]["n_tokens"] == 0)


def test_a_bigram_counts_as_often_as_a_text_has_it():
    fitted = model.Model([], model.np.zeros(8), model.np.zeros(8), model.np.zeros(0, int), model.np.zeros(0), None, 1)
    batch = model.pa.RecordBatch.from_pydict({"doc_id": [1], "lang": ["x"], "text": ["a " * 70_001]})
    body, rows = next((b, e) for _, kind, _, b, e in model._packed(batch, fitted, model.Ids([]), 1, 1) if kind == 1)
    key = (1 << model._SHIFT) | 1
    sums = model._sums(body, int.from_bytes(rows, "little"), model.np.array([key]), model.np.array([0.5]))
    assert model.np.frombuffer(sums).tolist() == [35_000.0]


def test_junk_goes_and_trusted_stays(documents, labels):
    rng = random.Random(7)
    rows = [(i, text(rng, junk=i % 5 == 0), "s") for i in range(400)] + [(1000, None, "s"), (None, "w1 w2", "s"), (3, text(rng), "s")]
    docs = documents(rows).withColumn("perplexity", F.lit("clash")).withColumn("own", F.lit(0))
    known = labels([(i, int(i % 5 != 0), 0) for i in range(0, 400, 2)] + [(None, 1, 0), (7, None, None)])
    found = model.classify(docs, known).collect()
    assert len(found) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert not kept[1000] and sum(kept[i] for i in range(400) if i % 5) >= 0.8 * 320
    assert not any(kept[i] for i in range(0, 400, 5))


def test_languages_have_thresholds_of_their_own_and_null_is_one(documents, labels, monkeypatch):
    monkeypatch.setattr(model, "LEAST_TEXTS", 5)
    rng = random.Random(8)
    docs = documents([text(rng) for _ in range(300)]).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") % 3 == 1, "y"))
    found = model.classify(docs, labels([(i, 1, 0) for i in range(300)])).collect()
    assert len({r["threshold"] for r in found}) == 3


def test_languages_with_few_texts_have_thresholds_of_their_own_too(documents, labels):
    rng = random.Random(8)
    docs = documents([text(rng) for _ in range(120)]).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") % 3 == 1, "y"))
    found = model.classify(docs, labels([(i, 1, 0) for i in range(120)])).collect()
    assert len({r["threshold"] for r in found}) == 3


def test_without_trusted_rows_and_empty(documents, labels):
    assert [r["kept"] for r in sorted(model.classify(documents(["a b", ""]), labels([])).collect())] == [True, False]
    assert model.classify(documents([]), labels([])).collect() == []


def test_spellings_are_a_distribution_and_unknown_words_pay_for_theirs():
    counts = model.np.zeros((257, 257))
    for t in ("the", "then", "hen", "é"):
        own = model._spelled(t)
        model.np.add.at(counts, (own[:-1], own[1:]), 1)
    letters = model.spelling(counts)
    assert model.np.allclose(model.np.exp(letters).sum(axis=1), 1)
    ids = model.Ids(["the"], letters)
    known, spelled = ids.read("the then zzq the")
    assert known.tolist()[1] == known.tolist()[4] and known.tolist()[2] == known.tolist()[3] == 1
    costs = [sum(letters[a, b] for a, b in zip(x, x[1:], strict=False)) for x in (model._spelled("then"), model._spelled("zzq"))]
    assert math.isclose(spelled, sum(costs)) and costs[1] < costs[0] - 5


@pytest.mark.parametrize("salted", [1, 7])
def test_random_letters_go(documents, labels, monkeypatch, salted):
    monkeypatch.setattr(model, "TEXTS_A_SALT", 400_000 if salted == 1 else 1500)
    monkeypatch.setattr(model, "LEAST_SHARDS", 4)
    rng = random.Random(3)
    parts = ["an", "the", "ing", "er", "tion", "wh", "ou", "ly"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(3000)]
    good = [" ".join(rng.choices(words, k=120)) for _ in range(360)]
    junk = [" ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(3, 9))) for _ in range(200)) for _ in range(40)]
    docs = documents([*good, *junk])
    found = {r["doc_id"]: r["kept"] for r in model.classify(docs, labels([(i, 1, 0) for i in range(300)])).collect()}
    assert not any(found[i] for i in range(360, 400))
    assert sum(found[i] for i in range(360)) >= 0.95 * 360


def test_very_long_texts(documents, labels):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("an", "the", "ing") for b in ("er", "ou", "ly")]
    docs = documents([" ".join(rng.choices(words, k=60)) for _ in range(80)] + [" ".join(rng.choices(words, k=200_000)), "q" * 100_000])
    found = {r["doc_id"]: r for r in model.classify(docs, labels([(i, 1, 0) for i in range(80)])).collect()}
    assert found[80]["n_tokens"] == 200_000 and found[80]["kept"] and not found[81]["kept"]
