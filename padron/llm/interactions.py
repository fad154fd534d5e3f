"""How document filters interact: what each one removes, in every order in which they may be applied.

The figures of a text come from one pass of a finite-state transducer over its UTF-8 bytes. Its table says, for the
state (between words, in a word) and the class of the next byte, which state follows and what to note: a word begins,
a word ends, a code point, a capital, a symbol. The spans of the words go into a hash table on the way; a place of
that table is shared only by words of one text whose bytes have been compared.

Which filters a document fails is a set, so a part of the table (a source) is described by the number of documents
per set. Every order of the filters is read from those numbers: documents are not visited once per order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import SPACE_BYTES, chunks, mix, stored, text_bytes

FILTERS = "ABCDE"
MIN_WORDS = 50
SYMBOLS = b"#$%&*|"
FIGURES = ("n_words", "n_distinct", "n_capitals", "n_codepoints", "n_symbols")

# ---- the transducer ---------------------------------------------------------------------------------------------

BETWEEN, INSIDE = 0, 1
BEGIN, END, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8, 16
_SPACE, _UPPER, _MARK, _OTHER, _FOLLOWING = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[list(SPACE_BYTES)] = _SPACE
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[list(SYMBOLS)] = _MARK
_CLASS[0x80:0xC0] = _FOLLOWING
#: By state and class: the state that follows, and what is noted. A byte that continues a code point notes no new one.
_NEXT = np.array([[BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], [BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE]], np.uint8)
_NOTED = np.array(
    [[POINT, BEGIN | POINT | CAPITAL, BEGIN | POINT | SYMBOL, BEGIN | POINT, BEGIN],
     [END | POINT, POINT | CAPITAL, POINT | SYMBOL, POINT, 0]], np.uint8,
)
#: The state after a byte is the same from either state, so all bytes of a chunk find theirs at once.
_AFTER = _NEXT[BETWEEN][_CLASS]
_NOTED_BY_BYTE = _NOTED[:, _CLASS]


def transduce(flat: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """What is noted at each byte of a run of texts; every text starts between words, and ends a word it is in."""
    state = np.zeros(len(flat), np.uint8)
    state[1:] = _AFTER[flat[:-1]]
    state[offs[:-1][np.diff(offs) > 0]] = BETWEEN
    return _NOTED_BY_BYTE[state, flat]


# ---- the hash table of words --------------------------------------------------------------------------------------

_BLOCK = 8
#: Words beyond this many bytes are hashed and compared as whole byte strings, others in blocks of eight bytes.
_LONG = 64
_KEPT_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(_BLOCK)] + [(1 << 64) - 1], np.uint64)


class _Words:
    """Word spans of a chunk: hashes, and exact comparison of two words by their place."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.raw = np.concatenate([flat, np.zeros(_BLOCK, np.uint8)])
        #: The eight bytes from any place on as one number.
        self.blocks = np.ndarray(len(flat) + 1, np.dtype("<u8"), buffer=self.raw, strides=(1,))
        self.starts, self.lengths = starts, lengths

    def block(self, words: np.ndarray, k: int) -> np.ndarray:
        kept = np.minimum(self.lengths[words] - _BLOCK * k, _BLOCK)
        return self.blocks[self.starts[words] + _BLOCK * k] & _KEPT_BYTES[kept]

    def bytes_of(self, word: int) -> bytes:
        return self.raw[self.starts[word] : self.starts[word] + self.lengths[word]].tobytes()

    def hashes(self) -> np.ndarray:
        found = mix(self.lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for k in range(_LONG // _BLOCK):
            at = np.flatnonzero((self.lengths > _BLOCK * k) & (self.lengths <= _LONG))
            if not len(at):
                break
            found[at] = mix(found[at] ^ self.block(at, k))
        for w in np.flatnonzero(self.lengths > _LONG):
            found[w] = int.from_bytes(hashlib.blake2b(self.bytes_of(w), digest_size=8).digest(), "little")
        return found

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        equal = self.lengths[a] == self.lengths[b]
        for k in range(_LONG // _BLOCK):
            at = np.flatnonzero(equal & (self.lengths[a] > _BLOCK * k) & (self.lengths[a] <= _LONG))
            if not len(at):
                break
            equal[at] = self.block(a[at], k) == self.block(b[at], k)
        for i in np.flatnonzero(equal & (self.lengths[a] > _LONG)):
            equal[i] = self.bytes_of(a[i]) == self.bytes_of(b[i])
        return equal


def distinct_words(words: _Words, rows: np.ndarray, n_rows: int, hashes: np.ndarray | None = None) -> np.ndarray:
    """Distinct words per text, by an open-addressed table into which all words of a chunk go in rounds.

    In a round every word that has no place yet looks at its next place. The first word there takes a free place;
    whoever finds its own text's equal word, byte by byte, is a repetition; the others look further.
    """
    hashes = words.hashes() if hashes is None else hashes
    bits = max(int(2 * len(rows)).bit_length(), 4)
    table = np.full(1 << bits, -1, np.int64)
    mask = np.uint64((1 << bits) - 1)
    place = mix(hashes ^ (rows.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))) & mask
    open_, first = np.arange(len(rows)), np.zeros(len(rows), bool)
    while len(open_):
        at = place[open_]
        free = table[at] < 0
        table[at[free][::-1]] = open_[free][::-1]  # of those that meet here, the first stays
        there = table[at]
        mine = there == open_
        first[open_[mine]] = True
        equal = rows[there] == rows[open_]
        equal[equal] = words.same(there[equal], open_[equal])
        open_ = open_[~equal]
        place[open_] = (place[open_] + np.uint64(1)) & mask
    return np.bincount(rows[first], minlength=n_rows)


def _figures(flat: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The figures of each text of a chunk, one row a text."""
    n = len(offs) - 1
    noted = transduce(flat, offs)

    def per_text(what: int) -> np.ndarray:
        at = np.flatnonzero(noted & what)
        return np.diff(np.searchsorted(at, offs))

    starts = np.flatnonzero(noted & BEGIN)
    rows = np.searchsorted(offs, starts, side="right") - 1
    ends = np.flatnonzero(noted & END)
    # A word ends where one is noted to, or with its text.
    nearest = np.append(ends, len(flat))[np.searchsorted(ends, starts)]
    words = _Words(flat, starts, np.minimum(nearest, offs[rows + 1]) - starts)
    return np.column_stack(
        [np.bincount(rows, minlength=n), distinct_words(words, rows, n), per_text(CAPITAL), per_text(POINT), per_text(SYMBOL)]
    )


def measure(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All columns but the text, with the figures and ``digest``, the SHA-256 of the text; null counts as empty.

    ``n_words`` and ``n_distinct`` count maximal runs of anything but ASCII white space, case-sensitively, and
    ``n_capitals``, ``n_codepoints``, ``n_symbols`` characters of the whole text. Texts are taken in chunks of about a
    megabyte, a longer text by itself. Columns of these names in ``docs`` raise.
    """
    if clash := {*FIGURES, "digest"} & set(docs.columns):
        raise ValueError(f"columns already there: {sorted(clash)}")
    kept = [c for c in docs.columns if c != text_col]
    names = [*kept, *FIGURES, "digest"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offs = text_bytes(batch.column(len(kept)))
            for at, to, part, own in chunks(flat, offs):
                table, raw = _figures(part, own), memoryview(part)
                digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(own[:-1], own[1:], strict=True)]
                columns = [c.slice(at, to - at) for c in batch.columns[:-1]]
                columns += [pa.array(table[:, i].astype(np.int64)) for i in range(len(FIGURES))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary())], names=names)

    schema = docs.select([F.col(f"`{c}`") for c in kept]).schema
    for name in FIGURES:
        schema = schema.add(name, "long")
    return docs.select([F.col(f"`{c}`") for c in (*kept, text_col)]).mapInArrow(work, schema.add("digest", "binary"))


# ---- what the filters do -------------------------------------------------------------------------------------------


def fails() -> dict[str, Column]:
    """The failure condition of each filter on the figures; E is worked out over the table by :func:`failures`."""
    return {
        "A": F.col("n_words") < MIN_WORDS,
        "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > 5 * F.col("n_codepoints"),
        "D": F.col("n_symbols") > 0,
    }


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def failures(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, part, failed, good, toxic``: per row the set of failed filters as bits, and what its labels say.

    E fails where a smaller ``doc_id`` of the table has the same text; so rows that share a text and the smallest id
    all pass, and a row without an id passes and is no other row's reason to fail. Several label rows of a document
    count as good (toxic) if any is; a row without an id has no labels.

    The smallest id of each text is a grouping with partial sums. It meets the rows by text and id together, so the
    copies of one text, however many, lie in different tasks.
    """
    none = F.lit(0)
    bits = sum((F.when(rule, F.lit(_bit(f))).otherwise(none) for f, rule in fails().items()), start=none)
    # Rows without an id match nothing below; a number of their own keeps them out of one task.
    rows = measured.select(
        "doc_id", "part", "digest", bits.cast("int").alias("failed"),
        F.coalesce("doc_id", F.xxhash64("digest", F.monotonically_increasing_id())).alias("key"),
    )
    first = rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("key"))
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"),
    )
    has_id = F.col("doc_id").isNotNull()
    joined = rows.join(first.withColumn("leads", F.lit(True)), ["digest", "key"], "left").join(known, "key", "left")
    return joined.select(
        "doc_id",
        "part",
        F.when(F.col("leads") | ~has_id, F.col("failed")).otherwise(F.col("failed") + _bit("E")).alias("failed"),
        (has_id & F.coalesce("good", F.lit(False))).alias("good"),
        (has_id & F.coalesce("bad", F.lit(False))).alias("toxic"),
    )


def every_order(failed: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from rows of ``part, failed, good, toxic``.

    Rows are first counted per part and set of failed filters. A part then has, for each set of filters, how many
    documents pass them all; every column is a difference of such numbers. ``shapley`` is the sum over all orders:
    a set ahead of a filter is met by (its size)! * (the others' number)! of them.
    """
    sets = range(1 << len(FILTERS))
    counts = failed.groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("bigint")).alias("good"), F.sum(F.col("toxic").cast("bigint")).alias("toxic")
    )

    def passing(column: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("failed").bitwiseAND(s) == 0, F.col(column)).otherwise(0)) for s in sets])

    alone = F.array(*[F.sum(F.when(F.col("failed") == _bit(f), F.col("n")).otherwise(0)) for f in FILTERS])
    parts = counts.groupBy("part").agg(*[passing(c).alias(f"_{c}") for c in ("n", "good", "toxic")], alone.alias("_alone"))

    def passed(column: str, s: Column | int) -> Column:
        return F.get(F.col(f"_{column}"), s if isinstance(s, Column) else F.lit(s))

    def shapley(name: str) -> Column:
        others = [s for s in sets if not s & _bit(name)]
        weight = {s: factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) for s in others}
        return sum((weight[s] * (passed("n", s) - passed("n", s | _bit(name))) for s in others), start=F.lit(0))

    parts = parts.withColumn("_shapley", F.array(*[shapley(f) for f in FILTERS]))
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            steps.append(("".join(order), i + 1, FILTERS.index(f), before, before | _bit(f)))
            before |= _bit(f)
    shape = "array<struct<filter_order: string, step: int, at: int, before: int, after: int>>"
    plan = F.from_json(F.lit("[" + ",".join(f'{{"filter_order":"{o}","step":{i},"at":{a},"before":{b},"after":{c}}}' for o, i, a, b, c in steps) + "]"), shape)
    at, before, after = F.col("at"), F.col("before"), F.col("after")
    removed = passed("n", before) - passed("n", after)
    alone_fails = passed("n", 0) - passed("n", F.expr("shiftleft(1, at)"))
    return parts.select("*", F.inline(plan)).select(
        "part", "filter_order", "step",
        passed("n", after).alias("kept"),
        removed.alias("removed"),
        (alone_fails - removed).alias("redundant"),
        F.get("_alone", at).alias("unique_fails"),
        (passed("good", before) - passed("good", after)).alias("good_lost"),
        (passed("toxic", before) - passed("toxic", after)).alias("toxic_lost"),
        F.get("_shapley", at).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``docs`` needs ``doc_id, text, source`` (a part is a source; null is the empty string) and ``labels`` needs
    ``doc_id, quality, toxic``; other columns are not read. An empty table has no parts, so no rows. Repeated rows
    count each. Texts are read once and do not leave their task: what is stored is a line of figures per row.
    """
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    return every_order(failures(stored(measure(rows), "interactions-figures"), labels))
