"""Exact top-k search: tiled matrix products of query blocks and shards, partial selection per tile, tree merging.

Vectors are packed into blocks, dealt to shards by a hash of their id; queries likewise to query blocks. A tile is
one query block against one shard. Each tile runs matrix products on slices of the shard, keeps the k best per query
with a partial selection after each, and emits one list per query. Lists are merged in a tree of fixed fan-in, so no
task sees all lists of a query. Tile sides are fixed in vectors, so a task's memory does not grow with the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import mix

SCALE = 64
K = 20
TILE_QUERIES = 2048
TILE_SHARD = 8192
SLICE = 2048
FAN_IN = 32

_BLOCK = "query boolean, part bigint, dim int, ids binary, cells binary"
_LIST = "query_id bigint, vec_id bigint, score bigint, part bigint"


def top_k(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    tile_queries: int = TILE_QUERIES,
    tile_shard: int = TILE_SHARD,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows by the inner product of ``floor(scale * x)``.

    Rows with a null id, a null vector, or a null or non-finite component take no part. A query is compared with
    every row of another id whose vector is as long as its own; ties go to the smaller id. Rows that repeat an id
    and vector count once; with several vectors under one id each is a query and a candidate of its own. Scores
    beyond a long are held at its limits. Columns besides the two named are ignored. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vec"), is_query.alias("query"))
    valid = F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
    rows = rows.filter(valid).withColumn("query", F.coalesce("query", F.lit(False)))
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("query")).first()
    shards, groups = max(1, math.ceil(total / tile_shard)), max(1, math.ceil(asked / tile_queries))
    blocks = rows.mapInArrow(lambda it: _pack(it, shards, groups, scale), _BLOCK)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("query"), shards - 1).otherwise(groups - 1).cast("bigint")))
    tiles = (
        blocks.withColumn("other", other)
        .withColumn("shard", F.when(F.col("query"), F.col("other")).otherwise(F.col("part")))
        .withColumn("group", F.when(F.col("query"), F.col("part")).otherwise(F.col("other")))
        .select("query", "dim", "shard", "group", "ids", "cells")
    )
    lists = tiles.groupBy("dim", "shard", "group").applyInArrow(lambda t: _tile(t, k), _LIST)
    parts = shards
    while True:
        parts = math.ceil(parts / FAN_IN)
        lists = _best(lists.withColumn("part", F.expr(f"part div {FAN_IN}")), ["query_id", "part"], k)
        if parts <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")


def _best(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _pack(batches: Iterator[pa.RecordBatch], shards: int, groups: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Blocks of valid vectors by length and shard, and of queries by length and query block."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        lists = batch.column(1)
        asked = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        values = lists.flatten()
        flat = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        out = []
        spread = mix(ids.astype(np.uint64))
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            cells = flat[starts[at][:, None] + np.arange(dim)[None, :]].reshape(len(at), dim)
            fine = np.isfinite(cells).all(axis=1)
            at, cells = at[fine], np.floor(cells[fine] * scale)
            fine = np.isfinite(cells).all(axis=1)
            at, cells = at[fine], cells[fine]
            for query, rows, parts in ((False, np.arange(len(at)), shards), (True, np.flatnonzero(asked[at]), groups)):
                # The low bits choose the shard and the high bits the query block, so the two are independent.
                h = spread[at[rows]]
                part = ((h >> np.uint64(32 if query else 0)) & np.uint64(0xFFFFFFFF)) % np.uint64(parts)
                for p in np.unique(part):
                    own = rows[part == p]
                    out.append((query, int(p), int(dim), ids[at[own]].tobytes(), _narrow(cells[own])))
        names = ["query", "part", "dim", "ids", "cells"]
        types = [pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _narrow(cells: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of three types, which the first byte names."""
    most = np.abs(cells).max(initial=0)
    for code, kind in ((b"b", np.int8), (b"h", np.int16)):
        if most <= np.iinfo(kind).max:
            return code + cells.astype(kind).tobytes()
    return b"d" + cells.astype(np.float64).tobytes()


def _wide(cells: bytes, rows: int, dim: int) -> np.ndarray:
    kind = {b"b": np.int8, b"h": np.int16, b"d": np.float64}[cells[:1]]
    return np.frombuffer(cells, kind, offset=1).reshape(rows, dim).astype(np.float64)


def _stack(table: pa.Table, query: bool, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids, cells = [np.zeros(0, np.int64)], [np.zeros((0, dim))]
    for q, i, c in zip(table["query"].to_pylist(), table["ids"].to_pylist(), table["cells"].to_pylist(), strict=True):
        if q == query:
            ids.append(np.frombuffer(i, np.int64))
            cells.append(_wide(c, len(ids[-1]), dim))
    all_ids, all_cells = np.concatenate(ids), np.concatenate(cells)
    order = np.lexsort((*all_cells.T[::-1], all_ids)) if len(np.unique(all_ids)) < len(all_ids) else np.argsort(all_ids)
    all_ids, all_cells = all_ids[order], all_cells[order]
    same = np.zeros(len(all_ids), bool)
    same[1:] = (all_ids[1:] == all_ids[:-1]) & (all_cells[1:] == all_cells[:-1]).all(axis=1)
    return all_ids[~same], all_cells[~same]


def _tile(table: pa.Table, k: int) -> pa.Table:
    """The k best of one shard for each query of one block."""
    dim, part = table["dim"][0].as_py(), table["shard"][0].as_py()
    asked, queries = _stack(table, True, dim)
    found, cells = _stack(table, False, dim)
    big = float(np.abs(queries).max(initial=0)) * float(np.abs(cells).max(initial=0)) * max(dim, 1)
    ids = np.zeros((len(asked), 0), np.int64)
    scores = np.zeros((len(asked), 0), np.int64)
    for at in range(0, len(found) if len(asked) else 0, SLICE):
        product = _product(queries, cells[at : at + SLICE], big)
        own = asked[:, None] == found[None, at : at + SLICE]
        best, which = _select(product, own, k)
        ids = np.concatenate([ids, np.where(which >= 0, found[at + which], _NONE)], axis=1)
        scores = np.concatenate([scores, best], axis=1)
        order = np.lexsort((ids, -_shifted(scores, ids != _NONE)), axis=1)[:, :k]
        ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    keep = ids != _NONE
    return pa.table({
        "query_id": np.repeat(asked, keep.sum(axis=1)), "vec_id": ids[keep], "score": scores[keep],
        "part": np.full(int(keep.sum()), part, np.int64),
    })


#: Stands in lists for "no row"; the smallest long, which no id above it collides with.
_NONE = np.iinfo(np.int64).min


def _shifted(scores: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Scores to sort by, with rows that are none below all others; exact for every long."""
    return np.where(live, np.maximum(scores, _NONE + 2), _NONE + 1)


def _product(queries: np.ndarray, cells: np.ndarray, big: float) -> np.ndarray:
    """Integer inner products: exact in doubles below 2**53, beyond that in Python integers."""
    if big < 2**53:
        return (queries @ cells.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    wide = exact(queries) @ exact(cells).T if queries.shape[1] else np.zeros((len(queries), len(cells)), object)
    return np.clip(wide, np.iinfo(np.int64).min, np.iinfo(np.int64).max).astype(np.int64)


def _select(product: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row, ties to the left (ids ascend); -1 where there are fewer.

    A partial selection finds the k-th score; all above it and, from the left, as many at it as fit are taken.
    """
    rows, width = product.shape
    scores = np.where(own, _NONE, product)
    if width > k:
        kth = -np.partition(-np.maximum(scores, _NONE + 1), k - 1, axis=1)[:, k - 1 : k]
        above = scores > kth
        level = (scores == kth) & ~own
        take = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    else:
        take = np.ones_like(own)
    take &= ~own
    row, column = np.nonzero(take)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    width = min(k, product.shape[1])
    which = np.full((rows, width), -1, np.int64)
    best = np.full((rows, width), _NONE, np.int64)
    which[row, place], best[row, place] = column, product[row, column]
    return best, which
