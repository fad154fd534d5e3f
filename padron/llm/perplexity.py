"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, and thresholds on perplexity.

Tokens are words and runs of punctuation. The vocabulary is the ``VOCABULARY`` most frequent tokens of the trusted
training text; any other token is one of a few classes by its shape, whose probability it shares with all other words
there are: it is spelled out by a model of the bytes of the training text's tokens. The bigram model's probabilities
split into

    log P(w | v) = log gamma(v) + log P1(w) + bonus(v, w),        bonus = 0 for bigrams that training didn't see,

so the score of a text is a sum of look-ups, and of the spellings. What belongs to one token is bounded by the vocabulary and goes to
every task, and so do the bonuses of the ``FREQUENT`` most frequent bigrams, which would crowd single shards. All
other bigrams are joined by shards of a hash: texts send theirs, packed per batch as sorted keys and text numbers,
and the model its bonuses; a shard adds up the matches per text, and the sums of all shards meet per batch. The texts
of a shard are dealt over salts by their batch, with the model's part of the shard repeated, so that no shard grows with
the corpus.

Counts cover all trusted rows outside one fifth, which is held out to set the thresholds: the quantile of its
perplexities in each language, shrunk towards that of all languages, the less the more texts a language has.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import mix, narrowed, stored, texts

VOCABULARY = 50_000
FREQUENT = 65_536
LONGEST_TOKEN = 64
#: Bigrams of the model in a shard.
SHARD = 500_000
LEAST_SHARDS = 24
#: Texts whose bigrams of one shard meet in one task. Of a text, about a thousand bigrams are dealt over all shards.
TEXTS_A_SALT = 1_000_000
QUANTILE = 0.99
#: A language with so many held-out trusted texts has a threshold halfway between its own quantile and that of all.
LEAST_TEXTS = 40

TOKEN = re.compile(r"\w+|[^\w\s]+")
SHAPES = ("<s>", "<lower>", "<title>", "<upper>", "<number>", "<mixed>", "<marks>", "<other>")
_SHIFT = 20


def _shape(token: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return 6
    if token.islower():
        return 1
    if token.isupper():
        return 3 if len(token) > 1 else 2
    if token.istitle():
        return 2
    if token.isdigit():
        return 4
    return 5 if any(c.isdigit() or c.isupper() for c in token) else 7


_START = _END = 256
#: Added to the count of every pair of bytes.
_SMOOTHING = 0.05


def _spelled(token: str) -> np.ndarray:
    """The bytes of a token between a start and an end."""
    return np.array([_START, *token.encode("utf-8", "surrogatepass"), _END])


def spelling(counts: np.ndarray) -> np.ndarray:
    """Log-probability of each byte (or the end) after each byte (or the start), from counts of types of tokens."""
    counts = counts + _SMOOTHING
    return np.log(counts / counts.sum(axis=1, keepdims=True))


class Ids:
    """Token ids: shapes first, then the vocabulary. Remembers the shapes and spellings of tokens met lately."""

    def __init__(self, vocabulary: list[str], letters: np.ndarray | None = None):
        self.base = {t: i + len(SHAPES) for i, t in enumerate(vocabulary)}
        self.letters = letters
        self.known, self.cost = dict(self.base), dict.fromkeys(self.base, 0.0)

    def of(self, text: str) -> np.ndarray:
        """Ids of a text with the start in front."""
        return self.read(text)[0]

    def read(self, text: str) -> tuple[np.ndarray, float]:
        """Ids of a text with the start in front, and the log-probability of how its unknown tokens are spelled."""
        tokens = TOKEN.findall(text)
        known, cost = self.known, self.cost
        if len(known) > 400_000:
            known, cost = self.known, self.cost = dict(self.base), dict.fromkeys(self.base, 0.0)
        for t in set(tokens).difference(known):
            known[t] = _shape(t)
            if self.letters is not None:
                own = _spelled(t)
                cost[t] = float(self.letters[own[:-1], own[1:]].sum())
        ids = np.fromiter((0, *(known[t] for t in tokens)), np.int64, len(tokens) + 1)
        return ids, math.fsum([cost[t] for t in tokens]) if self.letters is not None else 0.0


@dataclass
class Model:
    """What every task gets of the model; the bonuses of rarer bigrams are in the table ``bonuses`` (key, bonus)."""

    vocabulary: list[str]
    unigram: np.ndarray  # log P1 by id
    backoff: np.ndarray  # log gamma by id
    frequent: np.ndarray  # sorted keys
    frequent_bonus: np.ndarray
    bonuses: DataFrame | None
    bigrams: int
    letters: np.ndarray | None = None  # log-probabilities of spellings, by byte and next byte


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and more, from the numbers of items counted 1 to 4 times."""
    n1, n2, n3, n4 = (max(float(x), 1.0) for x in counts)
    y = n1 / (n1 + 2 * n2)
    found = [k - (k + 1) * y * after / here for k, here, after in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.clip(found, 0.05, [0.95, 1.95, 2.95])


def train(docs: DataFrame, *, vocabulary: int = VOCABULARY, frequent: int = FREQUENT) -> Model:
    """A model of all texts of ``docs``; null and empty texts add nothing. An empty table gives a uniform model.

    ``vocabulary`` bounds the tokens that are words of the model; all others are spelled out.
    """
    counted = docs.select("text").mapInArrow(_count_tokens, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    counted = stored(counted, "perplexity-tokens")
    pairs = counted.select("token").mapInArrow(_count_bytes, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    table = np.zeros((_END + 1, _END + 1))
    for r in pairs.collect():  # at most one row a pair of bytes
        table[r["a"], r["b"]] = r["n"]
    letters = spelling(table)
    words = [r["token"] for r in counted.filter("n > 1").orderBy(F.desc("n"), "token").limit(vocabulary).select("token").collect()]
    size = len(words) + len(SHAPES)
    bigrams = stored(
        docs.select("text").mapInArrow(lambda it: _count_bigrams(it, words), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")),
        "perplexity-bigrams",
    )
    first, second = F.shiftright("key", _SHIFT).alias("v"), F.col("key").bitwiseAND((1 << _SHIFT) - 1).alias("w")
    by_count = bigrams.filter("n <= 4").groupBy("n").count().collect()
    d2 = discounts(np.array([sum(r["count"] for r in by_count if r["n"] == k) for k in (1, 2, 3, 4)]))
    # One row a token of the vocabulary in either table, so both are bounded.
    several = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") > 2)]
    contexts = bigrams.groupBy(first).agg(F.sum("n").alias("total"), *[c.alias(f"n{k}") for k, c in enumerate(several, 1)]).toPandas()
    total, gamma = np.zeros(size), np.ones(size)
    v = contexts["v"].to_numpy(np.int64)
    total[v] = contexts["total"]
    gamma[v] = (contexts[["n1", "n2", "n3"]].to_numpy(float) * d2).sum(axis=1) / total[v]
    follows = bigrams.groupBy(second).count().toPandas()
    before = np.zeros(size)
    before[follows["w"].to_numpy(np.int64)] = follows["count"]
    d1 = discounts(np.array([(before == k).sum() for k in (1, 2, 3, 4)]))
    share = np.where(before > 0, d1[np.clip(before, 1, 3).astype(int) - 1], 0.0)
    everything = max(before.sum(), 1.0)
    rest = share.sum() / everything if before.sum() else 1.0
    unigram = np.maximum(before - share, 0) / everything + rest / size
    if not len(v):
        return Model(words, np.log(unigram), np.log(gamma), np.zeros(0, np.int64), np.zeros(0), None, 0, letters)

    def bonuses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(float)
            a, b = key >> _SHIFT, key & ((1 << _SHIFT) - 1)
            direct = (n - d2[np.clip(n, 1, 3).astype(int) - 1]) / total[a]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.log1p(direct / (gamma[a] * unigram[b])))], names=["key", "n", "bonus"])

    table = bigrams.mapInArrow(bonuses, "key bigint, n bigint, bonus double")
    top = table.orderBy(F.desc("n"), "key").limit(frequent).toPandas().sort_values("key")
    count = bigrams.count()
    return Model(words, np.log(unigram), np.log(gamma), top["key"].to_numpy(np.int64), top["bonus"].to_numpy(float), table.select("key", "bonus"), count, letters)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for t in texts(batch.column(0)):
            found.update(TOKEN.findall(t))
        short = {t: n for t, n in found.items() if len(t) <= LONGEST_TOKEN}
        yield pa.RecordBatch.from_arrays([pa.array(short.keys(), pa.string()), pa.array(short.values(), pa.int64())], names=["token", "n"])


def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbouring bytes in all tokens of a task."""
    total = np.zeros((_END + 1) ** 2, np.int64)
    for batch in batches:
        for t in texts(batch.column(0)):
            own = _spelled(t)
            np.add.at(total, own[:-1] * (_END + 1) + own[1:], 1)
    at = np.flatnonzero(total)
    columns = [pa.array((at // (_END + 1)).astype(np.int32)), pa.array((at % (_END + 1)).astype(np.int32)), pa.array(total[at])]
    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])


def _count_bigrams(batches: Iterator[pa.RecordBatch], words: list[str]) -> Iterator[pa.RecordBatch]:
    ids = Ids(words)
    for batch in batches:
        own = [x for x in (ids.of(t) for t in texts(batch.column(0))) if len(x) > 1]
        if own:
            key, n = np.unique(np.concatenate([(x[:-1] << _SHIFT) | x[1:] for x in own]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])


# ---- scoring ------------------------------------------------------------------------------------------------------

_PACKED = "shard int, salt int, kind int, batch bigint, body binary, extra binary"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang, n_tokens, log_prob, perplexity`` of every document; a text without tokens has no perplexity.

    Repeated rows are scored alike, null ids and languages stay, and other columns are not read.
    """
    shards = max(LEAST_SHARDS, math.ceil(model.bigrams / SHARD))
    salts = max(1, math.ceil(docs.count() / shards * LEAST_SHARDS / TEXTS_A_SALT))
    bounded = replace(model, bonuses=None)
    packed = docs.select(F.col("doc_id").cast("bigint"), "lang", "text").mapInArrow(lambda it: _pack_texts(it, bounded, shards, salts), _PACKED)
    if model.bonuses is not None:
        every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
        of_model = model.bonuses.mapInArrow(lambda it: _pack_model(it, bounded, shards), _PACKED)
        packed = packed.unionAll(of_model.drop("salt").select("*", every).select(packed.columns))
    dealt = packed.repartition(shards * salts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind").drop("salt")
    sums = dealt.mapInArrow(_matched, "batch bigint, body binary, extra binary")
    scored = sums.groupBy("batch").applyInArrow(_added, "doc_id bigint, lang string, n_tokens bigint, log_prob double")
    ratio = F.exp(-F.col("log_prob") / F.when(F.col("n_tokens") > 0, F.col("n_tokens")))
    return scored.withColumn("perplexity", ratio)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def _squeezed(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join(len(a).to_bytes(4, "little") + a.tobytes() for a in arrays), 1)


def _widened(body: bytes, kinds: tuple) -> list[np.ndarray]:
    raw, at, out = zlib.decompress(body), 0, []
    for kind in kinds:
        n = int.from_bytes(raw[at : at + 4], "little")
        out.append(np.frombuffer(raw, kind, n, at + 4))
        at += 4 + n * np.dtype(kind).itemsize
    return out


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [("shard", pa.int32()), ("salt", pa.int32()), ("kind", pa.int32()), ("batch", pa.int64()), ("body", pa.binary()), ("extra", pa.binary())]
    columns = list(zip(*out, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def _pack_texts(batches: Iterator[pa.RecordBatch], model: Model, shards: int, salts: int) -> Iterator[pa.RecordBatch]:
    """Per batch: a header with what the task can score itself, and per shard the other bigrams by text number.

    The batch's number comes from the partition and its place in it, so a task that runs again gives the same.
    """
    ids, number = Ids(model.vocabulary, model.letters), TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in range(0, batch.num_rows, 4096):
            own = batch.slice(part, 4096)
            number += 1
            salt = int(mix(np.array([number], np.uint64))[0] % np.uint64(salts))
            yield _rows([(r[0], salt, *r[1:]) for r in _packed(own, model, ids, shards, number)])


def _packed(batch: pa.RecordBatch, model: Model, ids: Ids, shards: int, number: int) -> list[tuple]:
    base, size, keys, rows = [], [], [], []
    for i, t in enumerate(texts(batch.column(2))):
        x, spelled = ids.read(t)
        size.append(len(x) - 1)
        base.append(float(model.unigram[x[1:]].sum() + model.backoff[x[:-1]].sum()) + spelled)
        keys.append((x[:-1] << _SHIFT) | x[1:])
        rows.append(np.full(len(x) - 1, i, np.int64))
    key, row = np.concatenate(keys), np.concatenate(rows)
    sums = np.array(base)
    if len(model.frequent):
        place = np.minimum(np.searchsorted(model.frequent, key), len(model.frequent) - 1)
        hit = model.frequent[place] == key
        sums += np.bincount(row[hit], model.frequent_bonus[place[hit]], len(sums))
        key, row = key[~hit], row[~hit]
    sink = pa.BufferOutputStream()
    header = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(sums)], names=["doc_id", "lang", "n_tokens", "log_prob"])
    with pa.ipc.new_stream(sink, header.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
        to.write_batch(header)
    out = [(number % shards, 2, number, None, sink.getvalue().to_pybytes())]
    # Bigrams in order of shard and key; each distinct one is sent once with its texts and their counts.
    pair, count = np.unique((key << 12) | row, return_counts=True)
    key, row = pair >> 12, (pair & 4095).astype(np.uint16)
    shard = _shard(key, shards)
    order = np.argsort(shard, kind="stable")
    key, row, count, shard = key[order], row[order], count[order], shard[order]
    for s, a, b in _runs(shard):
        new = np.r_[True, key[a + 1 : b] != key[a : b - 1]] if b > a else np.zeros(0, bool)
        at = np.flatnonzero(new)
        body = _squeezed(np.diff(key[a:b][at], prepend=0), np.diff(np.r_[at, b - a]).astype(np.uint16), row[a:b], count[a:b].astype(np.uint32))
        out.append((s, 1, number, body, batch.num_rows.to_bytes(4, "little")))
    return out


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.r_[0, np.flatnonzero(np.diff(values)) + 1, len(values)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield int(values[a]), int(a), int(b)


def _pack_model(batches: Iterator[pa.RecordBatch], model: Model, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, bonus = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float32)
        rare = ~np.isin(key, model.frequent)
        key, bonus = key[rare], bonus[rare]
        shard = _shard(key, shards)
        order = np.lexsort((key, shard))
        key, bonus, shard = key[order], bonus[order], shard[order]
        yield _rows([(s, 0, 0, 0, _squeezed(np.diff(key[a:b], prepend=0), bonus[a:b]), None) for s, a, b in _runs(shard)])


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard the model comes first, then the texts' bigrams: sums of bonuses per text; headers pass through."""
    shard, parts, keys, bonus = None, [], np.zeros(0, np.int64), np.zeros(0)
    for batch in batches:
        out = []
        for s, kind, number, body, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if s != shard:
                shard, parts, keys, bonus = s, [], np.zeros(0, np.int64), np.zeros(0)
            if kind == 0:
                k, v = _widened(body, (np.int64, np.float32))
                parts.append((np.cumsum(k), v))
            elif kind == 2:
                out.append((number, None, extra))
            else:
                if parts:
                    keys, bonus = (np.concatenate(x) for x in zip(*parts, strict=True))
                    order = np.argsort(keys)
                    keys, bonus, parts = keys[order], bonus[order].astype(float), []
                if len(keys):
                    out.append((number, _sums(body, int.from_bytes(extra, "little"), keys, bonus), None))
        columns = list(zip(*out, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["batch", "body", "extra"]
        )


def _sums(body: bytes, rows: int, keys: np.ndarray, bonus: np.ndarray) -> bytes:
    key, times, row, count = _widened(body, (np.int64, np.uint16, np.uint16, np.uint32))
    key = np.cumsum(key)
    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    value = np.where(keys[place] == key, bonus[place], 0.0)
    return np.bincount(row, np.repeat(value, times) * count, rows).tobytes()


def _added(table: pa.Table) -> pa.Table:
    """The documents of one batch: the header's sums and those of all shards. As large as a batch, whatever the table."""
    header = pa.ipc.open_stream(next(x for x in table["extra"].to_pylist() if x is not None)).read_all()
    sums = header["log_prob"].to_numpy()
    # Sorted, so that the order in which shards arrive changes nothing.
    for body in sorted(x for x in table["body"].to_pylist() if x is not None):
        sums = sums + np.frombuffer(body)
    return header.set_column(3, "log_prob", pa.array(np.round(sums, 6)))


def classify(docs: DataFrame, labels: DataFrame, *, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, lang, n_tokens, perplexity, threshold, kept`` of every document.

    Rows that ``labels`` (doc_id, quality 0/1) marks 1 are the trusted text. Documents without tokens have no
    perplexity and are not kept. A null language is a language of its own. Without trusted rows the model is uniform
    and there is no threshold: every document with tokens is kept. An empty table gives an empty one.
    """
    trusted = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    rows = docs.select("doc_id", "lang", "text")
    # The same join at every size: ids of trusted rows grow with the corpus, so they are not broadcast while they are few.
    learned = trusted.filter(fold != 0).hint("merge")
    model = train(stored(narrowed(rows, learned, "doc_id").join(learned, "doc_id", "left_semi").select("text"), "perplexity-trusted"))
    scored = stored(score(rows, model), "perplexity-scores")
    held = scored.join(trusted.filter(fold == 0), "doc_id", "left_semi").filter("perplexity is not null")
    cut = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = held.groupBy("lang").agg(cut.alias("own"), (F.count(F.lit(1)) / (F.count(F.lit(1)) + LEAST_TEXTS)).alias("share"))
    overall = held.agg(cut.alias("all")).first()["all"]
    joined = scored.join(by_lang.select(F.col("lang").alias("_l"), "own", "share"), F.col("lang").eqNullSafe(F.col("_l")), "left")
    all_ = F.lit(overall).cast("double")
    threshold = F.coalesce(all_ + F.col("share") * (F.col("own") - all_), all_)
    kept = F.coalesce(F.col("perplexity") <= F.coalesce(threshold, F.lit(math.inf)), F.lit(False))
    return joined.select("doc_id", "lang", "n_tokens", "perplexity", threshold.alias("threshold"), kept.alias("kept"))
