"""Helpers the operators share: stored intermediate tables, text columns as Arrow, word hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.session import shared_folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: Bytes of text handled at once by the numpy helpers; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: evaluated once, and not lost with an executor."""
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of the map that :func:`narrowed` sends to every task: half a megabyte, whatever the tables.
MAP_BITS = 1 << 22


def narrowed(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among that of ``ids``, ahead of a join that decides it.

    Saves shuffling texts that the join would drop. A map of fixed size can let other rows pass, all of them when
    there are very many ids, but never drops one that belongs.
    """
    place = F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(MAP_BITS))
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    bits = ids.select(place.alias("_place")).groupBy(F.expr("_place div 64").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    placed = df.withColumn("_place", place).withColumn("_word", F.expr("_place div 64"))
    return placed.join(F.broadcast(bits), "_word").filter(F.col("_bits").bitwiseAND(bit) != 0).select(*[F.col(f"`{c}`") for c in df.columns])


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def in_order(weights: np.ndarray) -> np.ndarray:
    """Running sums that start at 0: one more entry than there are weights."""
    out = np.zeros(len(weights) + 1, dtype=np.int64)
    np.cumsum(weights, out=out[1:])
    return out


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of a column; null becomes the empty text."""
    return pc.fill_null(column, "").to_pylist()


def portions(batch: pa.RecordBatch, at: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts in column ``at`` have about ``size`` bytes; a longer text is a slice by itself."""
    offs = in_order(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    first, rows = 0, batch.num_rows
    while first < rows:
        to = max(first + 1, int(np.searchsorted(offs, offs[first] + size, side="right")) - 1)
        yield batch.slice(first, to - first)
        first = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if column.null_count or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offs - offs[0]


def chunks(flat: np.ndarray, offs: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first row, row after the last, their bytes and offsets."""
    at, rows = 0, len(offs) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, side="right")) - 1)
        yield at, to, flat[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


# ---- word hashes ------------------------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACE_BYTES)] = False
_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        base = 0x5851F42D4C957F2D
        for key, p in (("up", base), ("down", pow(base, -1, 1 << 64))):
            table = np.full(size, p, np.uint64)
            table[0] = 1
            _powers[key] = np.cumprod(table)
    return _powers["up"], _powers["down"]


def word_hashes(flat: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a chunk of texts in order, and the offsets of the texts among the words.

    ``lower`` reads A-Z as a-z. Work and memory follow the bytes of the chunk.
    """
    n, rows = len(flat), len(offs) - 1
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = _IS_WORD[flat]
    first = np.zeros(n + 1, dtype=bool)
    first[offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER_CODES if lower else _CODES)[flat] * up[:n], out=sums[1:])
    found = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE)
    return mix(found), np.searchsorted(starts, offs)


def shingle_hashes(words: np.ndarray, offs: np.ndarray, width: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words in each text, and the offsets of the texts among them.

    ``whole``: a text with fewer words (but at least one) gives its whole sequence as one run; else it gives none.
    """
    count = np.diff(offs)
    runs = np.maximum(count - width + 1, 0)
    total = max(len(words) - width + 1, 0)
    sums = np.zeros(total, np.uint64)
    for j in range(width):
        sums += words[j : j + total] * _ODD[j]
    row = np.repeat(np.arange(len(count)), runs)
    within = np.arange(len(row)) - in_order(runs)[row]
    found = mix(sums[offs[:-1][row] + within])
    if whole and (short := np.flatnonzero((count > 0) & (count < width))).size:
        extra = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            has = count[short] > j
            extra[has] += words[offs[:-1][short[has]] + j] * _ODD[j]
        extra = mix(extra + count[short].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        runs = runs.copy()
        before = in_order(runs)[short]
        found = np.insert(found, before, extra)
        runs[short] = 1
    return found, in_order(runs)
