"""Quality rules with an isolation forest on their statistics.

Every text gives counts (words, symbols, repeated lines and words). Their ratios are points; each tree of an isolation
forest cuts its own sub-sample of them by random splits, and a document whose point is reached after few splits is
unusual. The sub-samples are drawn by a hash from the points of all documents that pass the base rules. The
score above which a document goes is calibrated on all labelled rows: it is where the share of good rows kept and
the share of bad rows found, together, are highest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import SPACE_BYTES, stored, texts

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: Rows per tree, and trees: the sub-samples of the method, which no tree shares with another one.
TREE_ROWS = 256
#: Shares of repeated lines and words up to this are found in ordinary text; splits there would tell nothing.
TOLERATED = 0.2
TREES = 150
BINS = 2000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_lines")


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the counts of each whole text; null counts as empty. Other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *COUNTS, *EXTRA]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([_counts(t) for t in texts(batch.column(1))], dtype=np.int64).reshape(-1, len(names) - 1)
            columns = [batch.column(0), *(pa.array(rows[:, i]) for i in range(rows.shape[1]))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:])
    return docs.select(id_col, text_col).mapInArrow(work, schema)


_SYMBOL_BYTES = [ord(c) for c in SYMBOLS]


def _counts(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()  # splits at the six ASCII white-space bytes only
    n = len(words)
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(text) - int(codes[list(SPACE_BYTES)].sum())
    seen, dup, solid = set(), 0, 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            solid += 1
            dup += line in seen
            seen.add(line)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return (
        n, chars, int(codes[_SYMBOL_BYTES].sum()), dup, _repeated(np.array([number[w] for w in words], np.int64)),
        int(codes[65:91].sum()), solid,
    )


def _repeated(words: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    size = int(words.max()) + 1
    pair = words[:-1] * size + words[1:]
    pair = np.unique(pair, return_inverse=True)[1]
    _, at, count = np.unique(pair[:-1] * size + words[2:], return_inverse=True, return_counts=True)
    often = count[at] > 1
    inside = np.zeros(len(words), bool)
    for j in range(3):
        inside[j : len(often) + j] |= often
    return int(inside.sum())


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def _points(table: dict[str, np.ndarray]) -> np.ndarray:
    """Of a text: mean word length and symbols per word as logarithms, the share of capitals among characters, and by
    how much the shares of repeated lines among lines and of words in repeated windows exceed what is usual."""
    words = np.maximum(table["n_words"], 1).astype(float)
    chars = np.maximum(table["word_chars"], 1).astype(float)
    lines = np.maximum(table["n_lines"], 1).astype(float)
    return np.column_stack(
        [np.log1p(table["word_chars"] / words), np.log1p(table["n_symbols"] / words), table["n_upper"] / chars,
         np.maximum(table["n_dup_lines"] / lines - TOLERATED, 0), np.maximum(table["n_repeat_words"] / words - TOLERATED, 0)]
    )


class Forest:
    """Random split trees over points in the order they were drawn; arrays of nodes, so all points walk a tree together.

    Each tree takes the next ``rows`` points. Where there are too few for all trees, each draws among all of them.
    """

    def __init__(self, points: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rows = min(rows, len(points))
        self.depth = int(np.ceil(np.log2(max(self.rows, 2))))
        size = 2 ** (self.depth + 1) - 1
        self.feature = np.zeros((trees, size), np.int16)
        self.cut = np.full((trees, size), np.inf)
        self.length = np.zeros((trees, size))
        for t in range(trees):
            if len(points) >= trees * self.rows:
                own = points[t * self.rows : (t + 1) * self.rows]
            else:
                own = points[rng.choice(len(points), self.rows, replace=False)] if len(points) else points
            self._grow(t, 0, own, 0, rng)

    def _grow(self, t: int, node: int, points: np.ndarray, depth: int, rng: np.random.Generator) -> None:
        low, high = (points.min(axis=0), points.max(axis=0)) if len(points) else (np.zeros(1), np.zeros(1))
        free = np.flatnonzero(high > low)
        if depth >= self.depth or len(points) < 2 or not len(free):
            at = [(node, depth)]  # every way below ends with this length
            while at:
                n, d = at.pop()
                self.length[t, n] = depth + _mean_length(len(points))
                if d < self.depth:
                    at += [(2 * n + 1, d + 1), (2 * n + 2, d + 1)]
            return
        f = rng.choice(free)
        cut = rng.uniform(low[f], high[f])
        self.feature[t, node], self.cut[t, node] = f, cut
        left = points[:, f] < cut
        self._grow(t, 2 * node + 1, points[left], depth + 1, rng)
        self._grow(t, 2 * node + 2, points[~left], depth + 1, rng)

    def scores(self, points: np.ndarray) -> np.ndarray:
        """0 to 1; higher means reached after fewer splits."""
        total = np.zeros(len(points))
        row = np.arange(len(points))
        for t in range(len(self.cut)):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (points[row, self.feature[t, node]] >= self.cut[t, node])
            total += self.length[t, node]
        mean = total / max(len(self.cut), 1)
        return 2.0 ** (-mean / max(_mean_length(self.rows), 1.0))


def _mean_length(n: int) -> float:
    """Mean depth at which a search in a random tree of n points ends."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    trees: int = TREES,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed, anomaly, threshold, kept`` of every document.

    ``labels`` (doc_id, quality 0/1) calibrates the threshold; without usable labels every document that passes the
    base rules is kept. Each of ``trees`` trees is grown on ``tree_rows`` documents of its own, drawn by a hash of id
    and counts among all that pass the base rules. A null text counts as empty, so it fails; a null id is kept in the result.
    Repeated rows are judged alike. An empty table gives an empty one.
    """
    stats = stored(
        statistics(docs).withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))), "rules-counts"
    )
    forest = Forest(_sample(stats, trees * tree_rows), trees, tree_rows)
    scored = _scored(stats, forest)
    threshold = _threshold(scored, labels)
    return scored.withColumn("threshold", F.lit(threshold)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") <= F.col("threshold"))
    )


def _sample(stats: DataFrame, rows: int) -> np.ndarray:
    """Points of the rows that hash lowest, in that order: the trees' draws, the same on every run.

    Rows that hash above twice the share that is wanted stay where they are, so that the driver gets about twice the
    rows and not so many from every task.
    """
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("forest"), *COUNTS), 32)
    fit = stats.filter("not base_failed").withColumn("_place", place)
    low = fit.filter(F.col("_place") < int(min(1.0, 2 * rows / max(fit.count(), 1)) * (1 << 32)))
    chosen = low.orderBy("_place", "doc_id", *COUNTS).limit(rows)
    table = chosen.select(*COUNTS, *EXTRA).toPandas()
    return _points({c: table[c].to_numpy() for c in table.columns})


def _scored(stats: DataFrame, forest: Forest) -> DataFrame:
    names = stats.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = {n: batch.column(names.index(n)).to_numpy(zero_copy_only=False) for n in (*COUNTS, *EXTRA)}
            score = np.round(forest.scores(_points(table)), 9)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, "anomaly"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema) + ", anomaly double"
    return stats.mapInArrow(work, schema)


def _threshold(scored: DataFrame, labels: DataFrame) -> float:
    """Where, over all labelled rows that pass the base rules, both kinds are told apart best; from a histogram."""
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)")
    bins = (
        scored.filter("not base_failed").select("doc_id", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
        .join(known, "doc_id").groupBy("bin", "quality").count().collect()
    )
    table = Counter({(r["bin"], r["quality"]): r["count"] for r in bins})
    bad, good = (np.array([table[b, q] for b in range(BINS + 1)], float) for q in (0, 1))
    if not bad.sum() or not good.sum():
        return 1.0
    gain = np.cumsum(good) / good.sum() + 1 - np.cumsum(bad) / bad.sum()
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return (best[len(best) // 2] + 1) / BINS
