import random
from collections import Counter
from math import exp, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from padron.llm import language

DOC = "doc_id bigint, text string, lang string, source string"
ENDINGS = {"aa": ["ing", "tion", "the", "wh"], "bb": ["ung", "keit", "sch", "ü"], "cc": ["ción", "ñe", "los", "que"]}


def runs(text):
    """All runs of one to four characters of the words of a text, each word with a space on both sides."""
    words, found = "".join(c if c.isalpha() else " " for c in text.lower()).split(" "), Counter()
    for w in words:
        padded = f" {w} "
        found.update(padded[i : i + n] for n in (1, 2, 3, 4) for i in range(len(padded) - n + 1) if w and padded[i : i + n] != " ")
    return found


def bucket(run, cache={}):  # noqa: B006
    """The bucket of a run, worked out one character at a time."""
    if run not in cache:
        code = 0
        for c in run:
            code = (code * (0x110000 + 1) + ord(c) + 1) % 2**64
        cache[run] = int(language.mix(np.array([code], np.uint64) + language._LENGTH_CODES[len(run)])[0] >> language._TOP_BITS)
    return cache[run]


def made(n=150, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(["aa", "aa", "aa", "bb", "cc"])
        text = " ".join("".join(rng.choices(ENDINGS[lang], k=rng.randint(1, 3))) for _ in range(rng.choice([1, 2, 8, 200])))
        rows.append((i, text + rng.choice([".", "", "\n12"]), lang, "s"))
    return rows


def brute(train, text):
    """Language and posterior by counting in dictionaries."""
    counted = Counter(bucket(r) for r in runs(text or "").elements())
    if not counted:
        return "und", 0.0
    logs = {}
    for lang in sorted({r[2] for r in train}):
        seen = Counter()
        for r in train:
            if r[2] == lang:
                seen.update(bucket(x) for x in runs(r[1]).elements())
        total = sum(seen.values()) + language.SMOOTHING * language.BUCKETS
        share = log(sum(r[2] == lang for r in train) / len(train))
        logs[lang] = share + sum(n * log((seen[b] + language.SMOOTHING) / total) for b, n in counted.items())
    top = max(logs.values())
    return max(logs, key=lambda x: (logs[x], [-ord(c) for c in x])), 1 / sum(exp(v - top) for v in logs.values())


def test_sparse_counts_are_those_of_the_runs():
    column = ["", "a", "ab c", "12 — !", "Ça va? ÑANDÚ", "x" * 3, "的 é1é", "İ ß"]
    found = Counter()
    for rows, buckets, counts in language.sparse(column):
        for r, b, n in zip(rows.tolist(), buckets.tolist(), counts.tolist(), strict=True):
            found[r, b] += n
    assert found == Counter((i, bucket(r)) for i, text in enumerate(column) for r in runs(text).elements())


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "the quick ñandú " * 50 + "w" * 300 + " 1 22 end"
    whole = Counter()
    for _, b, n in language.sparse([text, "z"]):
        whole.update(dict(zip(b.tolist(), n.tolist(), strict=True)))
    monkeypatch.setattr(language, "PIECE", 17)
    pieces, n_pieces = Counter(), 0
    for _, b, n in language.sparse([text, "z"]):
        pieces.update(dict(zip(b.tolist(), n.tolist(), strict=True)))
        n_pieces += 1
    assert pieces == whole and n_pieces > 10


def test_predictions_equal_counting_in_dictionaries(spark):
    train, rest = made(), made(40, seed=8)
    odd = [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "12 !", "bb", "s"), (None, "ung", None, "s"), (1003, "zzz", None, "s")]
    rows = [(500 + i, *r[1:]) for i, r in enumerate(rest)] + odd + [odd[2]]
    ignored = [(2000, None, "dd", "s"), (2001, "text", None, "s")]
    model = language.fit(spark.createDataFrame(train + ignored, DOC).repartition(5))
    assert model.languages == ["aa", "bb", "cc"]
    docs = spark.createDataFrame(rows, DOC).withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit(1))
    found = language.identify(docs, model).collect()
    assert len(found) == len(rows)
    by_text = {r[0]: r[1] for r in rows}
    for r in found:
        lang, score = brute(train, by_text[r["doc_id"]])
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-4)
    held = {r["doc_id"]: r["lang_pred"] for r in found}
    right = [held[500 + i] == r[2] for i, r in enumerate(rest) if len(r[1]) > 30]
    assert sum(right) >= 0.98 * len(right)


def test_ties_no_language_and_empty_tables(spark):
    same = [(1, "word", "bb", "s"), (2, "word", "aa", "s")]
    model = language.fit(spark.createDataFrame(same, DOC))
    assert language.identify(spark.createDataFrame(same, DOC), model).first()["lang_pred"] == "aa"
    none = language.fit(spark.createDataFrame([], DOC))
    found = language.identify(spark.createDataFrame(same, DOC), none).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)] * 2
    assert language.identify(spark.createDataFrame([], DOC), model).collect() == []


def test_too_many_values_are_refused(spark):
    rows = spark.range(language.MAX_LANGUAGES + 1).selectExpr("'a' AS text", "cast(id AS string) AS lang")
    with pytest.raises(ValueError, match="languages"):
        language.fit(rows)


def test_rows_held_out(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,), (9,)], "doc_id bigint")
    found = {r["doc_id"]: r["h"] for r in rows.select("doc_id", language.held_out(F.col("doc_id")).alias("h")).collect()}
    from zlib import crc32

    assert found == {None: True, **{i: crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 9)}}
