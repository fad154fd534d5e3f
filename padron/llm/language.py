"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Letters of a text, lower-cased, form words; a word with a space on both sides gives its runs of one to four characters.
Each run is hashed into one of 32,768 buckets. Training counts buckets per language; the smoothed log-probabilities are
a matrix (buckets by languages) that every task gets. Scoring turns a chunk of texts into one sparse matrix of counts
(text, bucket, count) and multiplies it with the languages' columns.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import mix, portions, texts

BUCKETS = 1 << 15
LENGTHS = (1, 2, 3, 4)
#: Added to the count of every bucket in every language.
SMOOTHING = 0.1
#: More values of ``lang`` than this are no languages: the matrix, which goes to all tasks, stays under 64 MB.
MAX_LANGUAGES = 512
UNKNOWN = "und"
#: Characters handled at once; a word is never cut, so a longer word is a piece by itself.
PIECE = 1 << 19
_SPACE = 32
#: Keeps runs of different lengths apart.
_LENGTH_CODES = mix(np.arange(max(LENGTHS) + 1, dtype=np.uint64))
#: A bucket is as many leading bits of a hash as number all buckets.
_TOP_BITS = np.uint64(64 - BUCKETS.bit_length() + 1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces(column: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of some texts, and which text each belongs to; long texts are cut where no letter stands."""
    letters = _letters()
    held, rows, size = [], [], 0
    for row, text in enumerate(column):
        points = _points(text)
        at = 0
        while at < len(points):
            to = min(at + PIECE, len(points))
            while to < len(points) and letters[points[to - 1]]:
                ahead = np.flatnonzero(~letters[points[to : to + PIECE]])
                to = to + int(ahead[0]) + 1 if len(ahead) else min(to + PIECE, len(points))
            held.append(points[at:to])
            rows.append(np.full(to - at, row, np.int64))
            size += to - at
            at = to
            if size >= PIECE:
                yield np.concatenate(held), np.concatenate(rows)
                held, rows, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(rows)


def grams(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs in the words of a piece, and the text each run belongs to."""
    letter = _letters()[points]
    same = np.zeros(len(points), bool)
    same[1:] = letter[1:] & letter[:-1] & (rows[1:] == rows[:-1])
    starts = letter & ~same
    # Each word takes two more places: a space ahead of it and one behind.
    place = np.cumsum(letter + 2 * starts.astype(np.int64))[letter] - 1
    n_words = int(starts.sum())
    out = np.full(int(letter.sum()) + 2 * n_words, _SPACE, np.uint64)
    word = np.zeros(len(out), np.int64)
    place -= 1  # the space behind a word is the last of its places
    out[place] = points[letter]
    owner = np.cumsum(starts)[letter] - 1
    word[place] = owner
    first = place[starts[letter]]
    word[first - 1] = np.arange(n_words)
    word[np.append(first[1:] - 2, len(out) - 1)[:n_words]] = np.arange(n_words)
    of = rows[starts]
    buckets, owners = [], []
    code = np.zeros(len(out), np.uint64)
    for n in LENGTHS:
        end = len(out) - n + 1
        if end <= 0:
            break
        code = code[:end] * np.uint64(0x110000 + 1) + out[n - 1 :][:end] + np.uint64(1)
        whole = word[:end] == word[n - 1 :][:end]
        if n == 1:
            whole = out != _SPACE  # a space alone says nothing
        buckets.append((mix(code[whole] + _LENGTH_CODES[n]) >> _TOP_BITS).astype(np.int64))
        owners.append(of[word[:end][whole]])
    return (np.concatenate(buckets), np.concatenate(owners)) if buckets else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def sparse(column: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The sparse count matrix of some texts piece by piece: texts, buckets, counts. A text may be in several pieces."""
    for points, rows in _pieces(column):
        buckets, owners = grams(points, rows)
        cells, counts = np.unique(owners * BUCKETS + buckets, return_counts=True)
        yield cells // BUCKETS, cells % BUCKETS, counts


class Model:
    """Languages in code point order, the matrix of log-probabilities and the logs of the languages' shares."""

    def __init__(self, languages: list[str], counts: np.ndarray, n_texts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=0, keepdims=True)
        self.matrix = np.log((counts + SMOOTHING) / (total + SMOOTHING * BUCKETS)).astype(np.float32)
        self.shares = np.log(n_texts / n_texts.sum()) if len(languages) else np.zeros(0)

    def scores(self, column: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text with each language, and the number of runs of each text."""
        found = np.tile(self.shares, (len(column), 1))
        runs = np.zeros(len(column), np.int64)
        for rows, buckets, counts in sparse(column):
            if not len(rows):
                continue
            starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            runs[rows[starts]] += np.add.reduceat(counts, starts)
            for k in range(len(self.languages)):
                found[rows[starts], k] += np.add.reduceat(counts * self.matrix[buckets, k].astype(np.float64), starts)
        return found, runs

    def predict(self, column: list[str]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text (the first in code point order on a tie) and its posterior."""
        if not self.languages:
            return [UNKNOWN] * len(column), np.zeros(len(column))
        found, runs = self.scores(column)
        best = found.argmax(axis=1)
        share = 1 / np.exp(found - found.max(axis=1, keepdims=True)).sum(axis=1)
        known = runs > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, share, 0.0)


def fit(docs: DataFrame) -> Model:
    """The model from all rows with a text and a language; others are passed over.

    Each task counts in one dense array per language it meets and hands on the buckets that are not empty, so what is
    shuffled and what the driver gets are bounded by buckets times languages. More than 512 languages raise.
    """
    rows = docs.select("text", "lang").filter("text is not null and lang is not null")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the column lang has other values")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        n_texts: dict[str, int] = {}
        for batch in (part for whole in batches for part in portions(whole, 0)):
            column, langs = texts(batch.column(0)), np.array(batch.column(1).to_pylist(), object)
            number = {lang: i for i, lang in enumerate(dict.fromkeys(langs.tolist()))}
            of = np.array([number[x] for x in langs], np.int64)
            for lang in number:
                held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                n_texts[lang] = n_texts.get(lang, 0) + int((of == number[lang]).sum())
            for points, rows in _pieces(column):
                buckets, owners = grams(points, rows)
                table = np.bincount(of[owners] * BUCKETS + buckets, minlength=len(number) * BUCKETS).reshape(-1, BUCKETS)
                for lang, i in number.items():
                    held[lang] += table[i]
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], n_texts[lang]))],
                names=["lang", "bucket", "n"],
            )

    counted = rows.mapInArrow(work, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    column = np.searchsorted(languages, counted.column("lang").to_pylist()) if languages else np.zeros(0, np.int64)
    bucket, n = counted.column("bucket").to_numpy(), counted.column("n").to_numpy()
    matrix, n_texts, inside = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages)), bucket >= 0
    matrix[bucket[inside], column[inside]] = n[inside]
    n_texts[column[~inside]] = n[~inside]
    return Model(languages, matrix, n_texts)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` of every whole text: the likeliest learned language and its posterior probability.

    ``und`` with score 0 where the text is null or has no letter, and for all rows if the model has no language. Other
    columns are not read; repeated rows are judged alike; null ids stay; an empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in portions(whole, 1)):
            found, score = shared.value.predict(texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), pa.array(score, pa.float64())], names=[id_col, "lang_pred", "score"]
            )

    return docs.select(id_col, text_col).mapInArrow(work, f"`{id_col}` {kind}, lang_pred string, score double")


def held_out(doc_id):
    """Whether a row may not be learned from; a row without an id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))
