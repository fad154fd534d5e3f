"""Near duplicates by MinHash with sequential Bayesian verification.

1. Each whole text gives the set of its word shingles as 64-bit hashes; equal sets are one node from here on.
2. A node's signature has ``BANDS * ROWS`` minima. Nodes that agree on all rows of a band share a bucket.
3. Candidate pairs are judged by batches of the signature: after each batch a pair goes if, by the posterior of its
   similarity given the agreements so far, it is ``THRESHOLD`` similar with a probability below ``MISS``.
4. Survivors are verified on their full sets.

Only components are asked for, so members that links have joined need no comparison among themselves. In a few rounds
every node meets one leader: the first member of the largest component in any of its buckets that is not its own. That
joins a group of copies for a pair a member and round. The nodes of buckets that then still hold several components
have all their remaining pairs compared, of those that a prefix filter leaves: in one order for all, the shingles of
two similar sets meet among the first ``n - ceil(0.8 n) + 1``, with enough of both sets behind. No pair is lost, so no
link between components is lost, and a frequent shingle brings nobody together who has rarer ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import chunks, mix, narrowed, shingle_hashes, stored, text_bytes, word_hashes
from padron.llm.components import components

WIDTH = 5
PERCENT = 80
#: 40 bands of 6: a pair at 0.8 shares no band with a probability of 5e-6.
BANDS, ROWS = 40, 6
BATCH = 24
MISS = 1e-6
#: Rounds in which every node meets one leader; they save work and change no result.
ROUNDS = 3

_SEEDS = mix(np.arange(1000, 1000 + 2 * BANDS * ROWS, dtype=np.uint64))
_TIMES = (_SEEDS[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_PLUS = (_SEEDS[BANDS * ROWS :] >> np.uint64(32)).astype(np.uint32)


def near_duplicates(
    docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z read as a-z. A text of fewer than ``width`` words is one
    shingle; a text without words, or null, has an empty set and links with nothing. Two rows are linked if their
    sets' intersection is at least ``percent`` of their union. ``component_id`` is the smallest id reachable;
    a row is kept if that is its own id. Ids are whole numbers and should be unique; repeated rows get the same
    component, and all of them with the smallest id are kept. A row with a null id is kept, with a null component
    unless its set equals another row's. Other columns are not read. An empty table gives an empty one.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = stored(texts.mapInArrow(lambda it: _signatures(it, width), _SIGNATURES), "near-signatures")
    same_set = ["n_shingles", "high", "low"]
    nodes = stored(
        rows.filter("n_shingles > 0 and id is not null").groupBy(*same_set)
        .agg(F.min_by("signature", "id").alias("signature"), F.min("id").alias("node")),
        "near-nodes",
    )
    bands = stored(nodes.select("node", "signature").mapInArrow(_bands, "band bigint, node bigint"), "near-bands")
    links = _links(texts, nodes.select("node", "signature"), bands, width, percent)
    joined = nodes.join(links, "node", "left").select(*same_set, F.coalesce("component", "node").alias("component"))
    return (
        rows.select("id", *same_set)
        .join(joined, same_set, "left")
        .withColumn("component_id", F.coalesce("component", "id"))
        .select(F.col("id").alias(id_col), "n_shingles", "component_id",
                F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


# ---- signatures -------------------------------------------------------------------------------------------------

_SIGNATURES = "id bigint, n_shingles bigint, high bigint, low bigint, signature binary"


def _sets(flat: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a chunk, sorted within the text, and their offsets."""
    words, at = word_hashes(flat, offs, lower=True)
    found, at = shingle_hashes(words, at, width, whole=True)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    found, row = found[new], row[new]
    return found, np.searchsorted(row, np.arange(len(at)))


def _signatures(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offs = text_bytes(batch.column(1))
        out: list[list] = [[], [], [], []]
        for _, _, own, own_offs in chunks(flat, offs):
            found, at = _sets(own, own_offs, width)
            size = np.diff(at)
            sums = np.zeros(len(found) + 1, np.uint64)
            for k, scrambled in ((1, found), (2, mix(found ^ np.uint64(0xA5A5A5A5)))):
                np.cumsum(scrambled, out=sums[1:])
                out[k].append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
            out[0].append(size)
            out[3] += [_minima(found[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)]
        whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out[:3]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in whole), pa.array(out[3], pa.binary())],
            names=["id", "n_shingles", "high", "low", "signature"],
        )


def _minima(shingles: np.ndarray) -> bytes:
    """The signature of a set: for each function the upper half of the least value, in 16 bits."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 512):  # stays in the processor's cache
        np.minimum(best, (low[at : at + 512, None] * _TIMES + _PLUS).min(axis=0), out=best)
    # The functions are linear, so their least values share low bits; scrambling makes all bits count.
    return (mix(best.astype(np.uint64) + _SEEDS[: BANDS * ROWS]) >> np.uint64(48)).astype(np.uint16).tobytes()


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column(0).to_numpy()
        cells = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(nodes), BANDS, ROWS).astype(np.uint64)
        key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(nodes), axis=0)
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, r])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(nodes, BANDS))], names=["band", "node"]
        )


# ---- candidates and links -----------------------------------------------------------------------------------------


def _links(texts: DataFrame, nodes: DataFrame, bands: DataFrame, width: int, percent: int) -> DataFrame:
    """``node, component`` of all nodes with a link."""
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("band")
    shared = stored(bands.join(buckets, "band"), "near-shared")
    groups, sets, tried = None, None, None
    for _ in range(ROUNDS):
        shared = _several(shared, groups)
        pairs = _one_leader_each(shared, tried)
        likely = _likely_pairs(pairs, nodes, percent)
        if sets is None:
            wanted = stored(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-wanted")
            sets = _sets_of(texts, wanted, width)
        else:
            missing = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(sets.select("id"), "id", "left_anti")
            sets = sets.unionAll(_sets_of(texts, stored(missing, "near-wanted"), width))
        found = stored(_verified(likely, sets, percent), "near-edges")
        tried = pairs if tried is None else tried.unionAll(pairs)
        if found.isEmpty():
            break
        groups = _merged(groups, found)
    shared = _several(shared, groups)
    open_ = stored(shared.select("node", "group").distinct(), "near-open")
    if not open_.isEmpty():
        missing = open_.select(F.col("node").alias("id")).join(sets.select("id"), "id", "left_anti")
        sets = sets.unionAll(_sets_of(texts, stored(missing, "near-wanted"), width))
        mine = stored(sets.join(open_.select(F.col("node").alias("id")), "id", "left_semi"), "near-open-sets")
        pairs = _prefix_pairs(mine, open_, percent).join(tried, ["a", "b"], "left_anti")
        found = stored(_verified(_likely_pairs(pairs, nodes, percent), mine, percent), "near-edges")
        if not found.isEmpty():
            groups = _merged(groups, found)
    return nodes.limit(0).select("node", F.col("node").alias("component")) if groups is None else groups.select("node", "component")


def _several(shared: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``band, node, group, size`` of the buckets that hold several groups. Groups only grow, so others never do again."""
    rows = shared.select("band", "node")
    if groups is None:
        return rows.select("band", "node", F.col("node").alias("group"), F.lit(1).cast("bigint").alias("size"))
    named = rows.join(groups, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("group"), F.coalesce("size", F.lit(1)).alias("size")
    )
    several = named.groupBy("band").agg(F.min("group").alias("_l"), F.max("group").alias("_h")).filter("_l != _h").select("band")
    return stored(named.join(several, "band"), "near-several")


def _one_leader_each(shared: DataFrame, tried: DataFrame | None) -> DataFrame:
    """(a, b): every node with one leader of another group, that of the largest group, which it has not met before."""
    first = F.min(F.struct((-F.col("size")).alias("size"), F.col("node").alias("leader"), F.col("group").alias("of"))).alias("l")
    leaders = shared.groupBy("band").agg(first).select("band", "l.leader", "l.of", F.col("l.size").alias("rank"))
    met = shared.join(leaders, "band").filter(F.col("group") != F.col("of"))
    met = met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"), "node", "rank", "leader")
    if tried is not None:
        met = met.join(tried, ["a", "b"], "left_anti")
    best = met.groupBy("node").agg(F.min(F.struct("rank", "leader", "a", "b")).alias("p"))
    return stored(best.select("p.a", "p.b").distinct(), "near-pairs")


def _merged(groups: DataFrame | None, found: DataFrame) -> DataFrame:
    """The groups with further links; what is known is carried on as one link per node."""
    if groups is not None:
        found = found.unionAll(groups.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")))
    return _groups(found)


# ---- prefix filter ----------------------------------------------------------------------------------------------


def prefix_length(n: int, percent: int) -> int:
    """Shingles, in one order for all sets, of which two sets that are similar enough share at least one."""
    return n - -(-percent * n // 100) + 1


def _prefix_pairs(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different groups whose prefixes share a shingle from which on both have enough to be similar.

    The order has those shingles first that only one group has, since they bring no groups together, then the others
    by the number of their nodes. So a node whose own shingles fill its prefix meets nobody.
    """
    tokens = sets.mapInArrow(_tokens, "id bigint, n bigint, token bigint").join(groups.select(F.col("node").alias("id"), "group"), "id")
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("group").alias("_l"), F.max("group").alias("_h"))
    across = tokens.join(counted.filter("_l != _h").select("token", "df"), "token")
    mine = Window.partitionBy("id")
    ranked = across.withColumn("_m", F.count(F.lit(1)).over(mine)).withColumn("_r", F.row_number().over(mine.orderBy("df", "token")))
    length = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    # Shingles of the set that are ahead of this one, and those from here on.
    rest = (F.col("_m") - F.col("_r") + 1).alias("rest")
    within = F.col("_r") <= length - (F.col("n") - F.col("_m"))
    rows = stored(ranked.filter(within).select("token", "id", "n", "group", rest), "near-prefixes")
    left = rows.select("token", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "group", "rest")])
    right = rows.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "group", "rest")])
    # All that two similar sets have in common is behind the first shingle they share; at least so much must be left.
    enough = F.least("rest_a", "rest_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    pairs = left.join(right, "token").filter((F.col("id_a") < F.col("id_b")) & (F.col("group_a") != F.col("group_b")) & enough)
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All shingles of each set, with the number of them."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held = [np.frombuffer(one.as_buffer(), np.int64) for one in part.column(1)]
            size = np.array([len(x) for x in held])
            columns = [np.repeat(part.column(0).to_numpy(), size), np.repeat(size, size), np.concatenate(held)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "n", "token"])


def _groups(edges: DataFrame) -> DataFrame:
    """``node, component, size`` of the nodes with a link."""
    found = stored(components(edges, "near-components"), "near-groups")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return stored(found.join(sizes, "component"), "near-sizes")


def least_agreements(size: int, percent: int, miss: float = MISS) -> list[int]:
    """For each batch end: the fewest agreements with which the posterior of enough similarity is ``miss`` or more.

    With a flat prior, the similarity given m agreements of n is Beta(m + 1, n - m + 1), and it is t or more with
    the probability that a binomial of n + 1 trials at t is m or less.
    """
    t, out = percent / 100, []
    for n in range(BATCH, size + 1, BATCH):
        total, m = 0.0, -1
        while total < miss and m < n:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _likely_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose signatures leave enough similarity possible."""
    of_a = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    of_b = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    both = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "sa", "sb")
    return stored(both.mapInArrow(lambda it: _likely(it, percent), "a bigint, b bigint"), "near-likely")


def _sets_of(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``id, shingles`` of the wanted ids, from their whole texts."""
    rows = narrowed(texts, wanted, "id").join(wanted, "id", "left_semi")
    return stored(rows.mapInArrow(lambda it: _full_sets(it, width), "id bigint, shingles binary"), "near-sets")


def _verified(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough on their full sets."""
    full = likely.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("fa")), "a")
    full = full.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("fb")), "b")
    return full.select("a", "b", "fa", "fb").mapInArrow(lambda it: _similar(it, percent), "a bigint, b bigint")


def _likely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    size = BANDS * ROWS
    least = least_agreements(size, percent)
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, size) for i in (2, 3))
        alive, agreed = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for step, need in enumerate(least):
            part = slice(step * BATCH, (step + 1) * BATCH)
            agreed = agreed + (left[alive, part] == right[alive, part]).sum(axis=1)
            alive, agreed = alive[agreed >= need], agreed[agreed >= need]
        yield batch.select([0, 1]).take(pa.array(alive))


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offs = text_bytes(batch.column(1))
        for a, b, own, own_offs in chunks(flat, offs):
            found, at = _sets(own, own_offs, width)
            held = [found[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(held, pa.binary())], names=["id", "shingles"])


def _similar(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            both = len(a) + len(b) - len(np.union1d(a, b)) if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) else 0
            keep.append(100 * both >= percent * (len(a) + len(b) - both) and both > 0)
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
