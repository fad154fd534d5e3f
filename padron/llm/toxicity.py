"""Toxicity by maximum-scoring segments of token log-odds.

Tokens (lower-case words and their beginnings of four and five characters) get log-odds of toxic against clean
labelled texts, by the number of texts that hold them, under a Dirichlet prior centred on both kinds together. Those that are significantly toxic form the
lexicon; every other word lowers a running score a little. A linear scan finds every maximal segment of a text, the
passages where the score rises most. The best scores of random clean text follow an extreme-value law, whose rate
comes from the lexicon's frequencies in clean text; it turns a segment's score into a p-value that allows for the
text's length. A monotone table from the labelled rows turns a text's evidence into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import portions, stored

TOKEN = re.compile(r"\w+")
PREFIXES = (4, 5)
#: Weight of the prior, in texts.
PRIOR_TEXTS = 100.0
MIN_Z = 3.0
#: With very many texts even a slight lean is significant; an entry must also be so much likelier in toxic ones (log-odds).
MIN_GAP = 1.5
MIN_TOXIC = 3
#: The most labelled rows a model is fitted on: with 16 bytes each, the bound on what their join broadcasts.
LABELLED = 200_000
#: Folds of the labelled rows, each of which is scored with a lexicon of the others to learn the table.
FOLDS = 5
#: A lexicon beyond this is an error: it goes to every task. Each entry stands in three labelled toxic texts at least.
MAX_LEXICON_BYTES = 64 << 20
#: What a word outside the lexicon takes from the running score.
DRIFT = 0.15
SIGNIFICANT = 0.05
#: Evidence (minus the log of the p-value) is put into bins of this width, up to a highest bin.
BIN, TOP_BIN = 0.5, 120
REMEMBERED = 50_000
#: Bytes of texts whose tokens are counted before they are handed on.
COUNTED_BYTES = 2 << 20


@dataclass
class Model:
    """A lexicon with scores, the extreme-value rate, and the probability of each bin of evidence."""

    scores: dict[str, float]
    rate: float
    table: list[float] = field(default_factory=lambda: [0.0])

    def word(self, word: str) -> float:
        """The score of the entry that fits best: the word, or one of its beginnings."""
        best = self.scores.get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n:
                best = max(best, self.scores.get(f"{word[:n]}*", 0.0))
        return best

    def p_value(self, score: float, length: int) -> float:
        """How likely clean text of this length has a segment that scores as high."""
        return -math.expm1(-length * math.exp(-self.rate * score))

    def evidence(self, segments: list[tuple[int, int, float]], length: int) -> float:
        """Of all significant segments: the sum of minus the logs of their p-values."""
        found = [-math.log(max(self.p_value(s, length), 1e-300)) for _, _, s in segments]
        return sum(x for x in found if x > -math.log(SIGNIFICANT)) or max(found, default=0.0)

    def probability(self, evidence: float) -> float:
        return self.table[min(int(evidence / BIN), len(self.table) - 1)]


def segments(places: list[int], values: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first word, word after the last, score), in order.

    ``places`` and ``values`` are the words with a positive score; each word between takes ``drift``. Every stretch
    is joined to an earlier one when that gives more than either has alone; each is handled a fixed number of times.
    """
    kept: list[list[float]] = []  # first, last + 1, total before it, total with it
    lower: list[int] = []  # for each kept one, the nearest earlier one whose total before is less, or -1
    total, previous = 0.0, -1
    for at, value in zip(places, values, strict=True):
        total -= drift * (at - previous - 1)
        previous = at
        first, before = at, total
        total += value
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j = lower[j]
            if j < 0 or kept[j][3] >= total:
                kept.append([first, at + 1, before, total])
                lower.append(j)
                break
            first, before = kept[j][0], kept[j][2]
            del kept[j:], lower[j:]
    return [(int(a), int(b), high - low) for a, b, low, high in kept]


def fit(docs: DataFrame, labels: DataFrame, *, labelled: int = LABELLED) -> Model:
    """The model from the labelled rows given; ``labels`` has doc_id and toxic (0/1, anything else is unlabelled).

    At most ``labelled`` labelled rows are used, chosen by a hash of the id, so that their ids fit in every task; token
    counts and the table cover all of those. The lexicon comes from all of them. The table that turns evidence into a
    probability must not be learned from texts the lexicon has seen: the rows are dealt into folds by a hash, and each
    fold is scored with a lexicon of the others. A document with several labels is toxic if any says so. Without toxic or
    without clean rows every probability is the share of toxic rows (0 if there are no labels).
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic", fold)
    measures = [F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}_{f}") for c in _COUNTED for f in range(FOLDS)]
    counts = stored(
        rows.mapInArrow(_token_counts, "token string, fold int, toxic bigint, clean bigint, clean_words bigint").groupBy("token").agg(*measures),
        "toxicity-counts",
    )
    # All folds, and all but one, for each.
    whole, *parts = _lexicons(counts, [range(FOLDS), *[[f for f in range(FOLDS) if f != left] for left in range(FOLDS)]])
    if whole is None:
        return Model({}, 1.0)
    whole.table = _table(rows, [p or whole for p in parts])
    return whole


_COUNTED = ("toxic", "clean", "clean_words")


def _lexicons(counts: DataFrame, folds: list[Sequence[int]]) -> list[Model | None]:
    """A model without its table from each set of folds, all from one pass; None for a set that holds no text."""
    # The row of the null token has the totals; a token that no toxic text holds can't enter a lexicon.
    row = counts.filter("token is null").first()
    if row is None:
        return [None] * len(folds)
    totals = [{c: float(sum(row[f"{c}_{f}"] for f in own)) for c in _COUNTED} for own in folds]
    columns: list[Column] = []
    for own, total in zip(folds, totals, strict=True):
        toxic, clean = (sum((F.col(f"{c}_{f}") for f in own), start=F.lit(0)) for c in _COUNTED[:2])
        prior = F.lit(PRIOR_TEXTS) * (toxic + clean) / (total["toxic"] + total["clean"] + 1)

        def log_odds(count: Column, n: float, prior: Column = prior) -> Column:
            return F.log((count + prior) / (F.lit(n + PRIOR_TEXTS) - count - prior))

        gap = log_odds(toxic, total["toxic"]) - log_odds(clean, total["clean"])
        z = gap / F.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
        significant = (toxic >= MIN_TOXIC) & (z >= MIN_Z) & (gap >= MIN_GAP)
        columns.append(F.when(significant, F.struct(gap.alias("gap"), clean.alias("clean"))).alias(f"e{len(columns)}"))
    enough = reduce(or_, [F.col(c).isNotNull() for c in (f"e{i}" for i in range(len(folds)))])
    entries = counts.filter("token is not null").select("token", *columns).filter(enough)
    size = entries.agg(F.coalesce(F.sum(F.octet_length("token") + 64), F.lit(0))).first()[0]
    if size > MAX_LEXICON_BYTES:
        raise ValueError(f"a lexicon of {size} bytes; the labels tell apart more than words")
    found = sorted(entries.collect(), key=lambda r: r["token"])
    models: list[Model | None] = []
    for i, total in enumerate(totals):
        own = [(r["token"], *r[f"e{i}"]) for r in found if r[f"e{i}"] is not None]
        model = Model({token: round(gap, 6) for token, gap, _ in own}, 1.0)
        model.rate = _rate([(gap, clean) for _, gap, clean in own], total["clean_words"])
        models.append(model if total["toxic"] + total["clean"] else None)
    return models


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean texts that hold each token, per fold; a null token carries the totals. Combined per batch."""
    for batch in (part for whole in batches for part in portions(whole, 0, COUNTED_BYTES)):
        found: dict[tuple[str | None, int], list[int]] = {(None, f): [0, 0] for f in range(FOLDS)}
        clean_words = [0] * FOLDS
        for text, toxic, fold in zip(_one_by_one(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = TOKEN.findall(text.lower())
            clean_words[fold] += len(words) * (1 - toxic)
            held = set(words)
            for k in PREFIXES:
                held.update([f"{w[:k]}*" for w in held if len(w) > k and w[-1] != "*"])
            for token in (None, *held):
                found.setdefault((token, fold), [0, 0])[1 - toxic] += 1
        rows = list(found.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in found], pa.string()), pa.array([f for _, f in found], pa.int32()),
             pa.array([v[0] for v in rows], pa.int64()), pa.array([v[1] for v in rows], pa.int64()),
             pa.array(clean_words + [0] * (len(rows) - FOLDS), pa.int64())],
            names=["token", "fold", *_COUNTED],
        )


def _rate(entries: list[tuple[float, int]], clean_words: float) -> float:
    """The positive root of mean(exp(rate * score)) = 1 over clean words: the extreme-value law's rate."""
    hits = [(gap, (clean + 0.5) / (clean_words + 1)) for gap, clean in entries]
    rest = max(1 - sum(p for _, p in hits), 0.0)
    if not hits or sum(g * p for g, p in hits) >= DRIFT * rest:
        return 0.5 if hits else 1.0  # the lexicon is as frequent in clean text: no law holds, so be cautious
    low, high = 1e-6, 1.0
    mean = lambda x: rest * math.exp(-x * DRIFT) + sum(p * math.exp(min(x * g, 700)) for g, p in hits)
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return low


def _table(rows: DataFrame, models: list[Model]) -> list[float]:
    """Toxic share by bin of evidence, made to rise by pooling neighbours; the rows of each fold have their own model."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = [_Scorer(m) for m in models]
        for batch in (part for whole in batches for part in portions(whole, 0)):
            bins = Counter(
                (min(int(score[f](t)[0] / BIN), TOP_BIN), y)
                for t, y, f in zip(_one_by_one(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in bins], pa.int32()), pa.array([y for _, y in bins], pa.int32()), pa.array(bins.values(), pa.int64())],
                names=["bin", "toxic", "n"],
            )

    found = rows.mapInArrow(work, "bin int, toxic int, n bigint").groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect()
    toxic, count = np.zeros(TOP_BIN + 1), np.zeros(TOP_BIN + 1)
    for r in found:
        count[r["bin"]] += r["n"]
        toxic[r["bin"]] += r["n"] * r["toxic"]
    return rising(toxic, count)


def rising(hits: np.ndarray, count: np.ndarray) -> list[float]:
    """Shares that never fall, least squares by pooling neighbours; bins without rows take the one before."""
    blocks: list[list[float]] = []  # hits, count, bins
    for h, n in zip(hits, count, strict=True):
        blocks.append([float(h), float(n), 1])
        while len(blocks) > 1 and (not blocks[-1][1] or not blocks[-2][1] or blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return [h / n if n else 0.0 for h, n, bins in blocks for _ in range(int(bins))]


class _Scorer:
    """Evidence and segments of texts, with the scores of words met lately."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, text: str) -> tuple[float, list[tuple[int, int, float]], int]:
        words = TOKEN.findall(text.lower())
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.model.word(w)
        values = [known[w] for w in words]
        places = [i for i, v in enumerate(values) if v]
        found = segments(places, [values[i] for i in places])
        return self.model.evidence(found, len(words)), found, len(words)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score, evidence, passages``: the probability, and every significant segment.

    Passages are ``(first_word, last_word, score, p_value)`` in words of the text. Empty and null texts have no
    evidence and no passages. Other columns are not read; repeated rows score alike; null ids stay.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    passage = "struct<first_word: int, last_word: int, score: double, p_value: double>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        shape = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())]))
        for batch in (part for whole in batches for part in portions(whole, 1)):
            evidence, passages = [], []
            for t in _one_by_one(batch.column(1)):
                e, found, n = scorer(t)
                evidence.append(e)
                judged = [(a, b - 1, s, model.p_value(s, n)) for a, b, s in found]
                passages.append([dict(zip(("first_word", "last_word", "score", "p_value"), x, strict=True)) for x in judged if x[3] <= SIGNIFICANT])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.probability(e) for e in evidence], pa.float64()),
                 pa.array(evidence, pa.float64()), pa.array(passages, shape)],
                names=[id_col, "score", "evidence", "passages"],
            )

    return docs.select(id_col, text_col).mapInArrow(work, f"`{id_col}` {kind}, score double, evidence double, passages array<{passage}>")


def _one_by_one(column: pa.Array) -> Iterator[str]:
    """Texts of a column, null as the empty text; only one is a Python string at a time."""
    return (t.as_py() or "" for t in column)


def held_out(doc_id):
    """Whether a row's label may not be learned from; a row without an id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def keep(docs: DataFrame, model: Model, *, below: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose probability is under ``below``, with all their columns; rows are judged one by one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for whole in batches:
            at = whole.schema.get_field_index(text_col)
            for batch in portions(whole, at):
                clean = [model.probability(scorer(t)[0]) < below for t in _one_by_one(batch.column(at))]
                yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
