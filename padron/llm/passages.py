"""Substring dedup: near-duplicate passages by compact windows.

Tokens are hashes of ``WIDTH``-word shingles. Under one hash function, the subsequences of at least ``WINDOW`` tokens
that share a minimum form one rectangle per node of the Cartesian tree over the token hashes whose span is that long:
a compact window. The windows of a text are read off the running minima of all stretches of ``WINDOW`` tokens, where
each such node is one run of equal minima, so the tree itself needs no building. Windows of two functions are
intersected, and the pair of minima is the key under which texts meet; there are ``BANDS`` such pairs.

Windows that share a key are all linked to the first of them. Passages found that way are gathered into groups; keys whose
windows lie in more than one group are open. Texts around open windows meet again by their rarer shingles, one of which each
pair with a passage shares (see :func:`_rare`): first each with the one before of another group, then, in the keys still
open, each with every one of another group, so no link is lost but those inside a group. Links of
two texts are joined where their intervals overlap in both, and each joined region is verified on the words, along diagonals: runs
of equal shingles are seeds, extended over the runs that continue them. A passage counts if its shingle sets are at least ``PERCENT`` similar and it has ``MIN_WORDS`` words. Texts that are
equal as a whole are one text here; its copies are reported without being compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import chunks, in_order, mix, narrowed, shingle_hashes, text_bytes, word_hashes
from padron.llm.common import stored as _stored
from padron.llm.components import components

WIDTH = 5
WINDOW = 40
BANDS = 3
PERCENT = 80
MIN_WORDS = 50
#: Matched shingles of one passage are at most so many tokens apart; regions are searched so far beyond their windows.
GAP, MARGIN = 12, 64
#: Tokens of the shortest passage; new room of that length lies in one run of a passage for at least the second number
#: of tokens, or for a whole run: of two runs at its ends, with a gap between them, one has half of the rest.
LEAST_TOKENS = MIN_WORDS - WIDTH + 1
LEAST_ROOM = (LEAST_TOKENS - GAP) // 2
#: Matches of two regions listed at once.
PAIRS = 1 << 18
#: Pairs for each zone, or each text, that are compared at once.
PER_SIDE = 4
#: A window lies in the passage with which it shares most words, and at least so many.
INSIDE = WINDOW // 2

_TIMES = mix(np.arange(77, 77 + 2 * BANDS, dtype=np.uint64)) | np.uint64(1)
_WINDOWS = "key bigint, doc bigint, span bigint"
_MET = f"{_WINDOWS}, lead bigint, lead_span bigint"
_FOUND = "a bigint, start_a int, words_a int, b bigint, start_b int, words_b int, similarity double"


#: Spark's own setting (4.1): shuffle files of a query go when it has ended, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """As :func:`common.stored`; what was shuffled for the table, which nothing reads again, goes when it is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return _stored(df, label)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, start_word, n_words, twin_id, twin_start, n_twins, similarity, whole, group_id`` for each repeated passage.

    One row per document and passage; ``twin`` is the smallest id it was matched with, ``n_twins`` how many it was.
    ``group_id`` is the smallest id reached from the passage over matches: passages of one group need not all be
    matched with each other, but no match between two groups is left out.
    Words are runs of anything but ASCII white space, A-Z read as a-z, counted from 0. ``whole`` marks documents equal
    to another one as a whole (of 50 words or more): each copy names the first of them, and the first the next.
    Passages within one document don't count. Texts that are null or have fewer than 50 words give no rows, nor do
    rows with a null id; rows that share an id and text are one document, and other columns are not read. An empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).filter("doc is not null and text is not null")
    marks = rows.select("doc", F.md5(F.col("text").cast("binary")).alias("mark"), F.length("text").alias("size"))
    marks = stored(marks.distinct(), "passages-marks")
    sets = marks.groupBy("mark", "size").agg(F.min("doc").alias("first"))
    copies = stored(marks.join(sets, ["mark", "size"]).filter("doc != first").select("doc", "first"), "passages-copies")
    single = rows.join(copies.select("doc").distinct(), "doc", "left_anti")
    windows = single.mapInArrow(_windows, _WINDOWS)
    met = stored(windows.repartition("key").sortWithinPartitions("key", "doc", "span").mapInArrow(_met, _MET), "passages-met")
    wanted = stored(met.select("doc").distinct(), "passages-wanted")
    held = narrowed(rows, wanted, "doc").join(wanted, "doc", "left_semi")
    tokens = stored(held.mapInArrow(_tokens, "doc bigint, tokens binary"), "passages-tokens")
    found = _found(met.select("doc", "span", F.col("lead").alias("twin"), F.col("lead_span").alias("twin_span")), tokens)
    groups = _groups(found)
    open_ = met
    for links in (_chained, _crossed):
        open_ = _open(open_.select("key", "doc", "span"), groups)
        zones = _zoned(open_, groups, tokens)
        more = _found(_alike(links(_rare(zones)), zones), tokens)
        if not more.isEmpty():
            found = found.unionAll(more)
            groups = _groups(found)
    return _result(found, groups, copies, rows, id_col)


def _found(links: DataFrame, tokens: DataFrame) -> DataFrame:
    """The passages of linked windows (doc, span, twin, twin_span), each two texts compared once, in parts by the first."""
    sides = [F.struct("doc", "span").alias("x"), F.struct(F.col("twin").alias("doc"), F.col("twin_span").alias("span")).alias("y")]
    ends = links.filter("doc != twin").select(F.greatest(*sides).alias("x"), F.least(*sides).alias("y"))  # the smaller id is always b
    link = F.struct(F.col("x.span").alias("sa"), F.col("y.span").alias("sb"))
    pairs = stored(ends.groupBy(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).agg(F.collect_set(link).alias("links")), "passages-pairs")
    parts = _parts(pairs, tokens)
    return _together([stored(_compared(pairs.filter(_mine(i, parts, "a")), tokens), "passages-found") for i in range(parts)])


def _compared(full: DataFrame, tokens: DataFrame) -> DataFrame:
    # Of both texts only the tokens around the links are compared, and of the first only these go on to the join with the second.
    for side in ("a", "b"):
        first = F.greatest(F.array_min(F.transform(f"links.s{side}", _first)) - MARGIN, F.lit(0)).cast("int")
        last = (F.array_max(F.transform(f"links.s{side}", _last)) + MARGIN + 1).cast("int")
        full = full.join(tokens.select(F.col("doc").alias(side), F.col("tokens").alias("_tokens")), side).withColumn(f"at_{side}", first)
        full = full.withColumn(f"t{side}", F.substring("_tokens", F.col(f"at_{side}") * 8 + 1, (last - F.col(f"at_{side}") + 1) * 8)).drop("_tokens")
    return full.select("a", "b", "links", "ta", "tb", "at_a", "at_b").mapInArrow(_verified, _FOUND)


def _parts(pairs: DataFrame, sides: DataFrame) -> int:
    """Into how many parts to take pairs, whose shuffle files go one after the other, so that a part follows ``sides``."""
    return max(1, -(-pairs.count() // max(1, PER_SIDE * sides.count())))


def _mine(part: int, parts: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(parts)) == part


def _together(parts: list[DataFrame]) -> DataFrame:
    """The rows of all parts; unions are nested as little as can be."""
    while len(parts) > 1:
        parts = [parts[i].unionAll(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _first(span: Column) -> Column:
    return F.shiftright(span, 32)


def _last(span: Column) -> Column:
    return span.bitwiseAND(F.lit(0xFFFFFFFF))


# ---- groups of passages -------------------------------------------------------------------------------------------


def _sides(found: DataFrame) -> DataFrame:
    """Every passage found, as (doc, start, n)."""
    other = found.select("b", "start_b", "words_b")
    return found.select(F.col("a").alias("doc"), F.col("start_a").alias("start"), F.col("words_a").alias("n")).unionAll(other).distinct()


def _groups(found: DataFrame) -> DataFrame:
    """``doc, start, n, group, group_id`` of every passage found; overlapping passages of a text are in one group.

    ``group`` numbers the first (doc, start) that is reached over matches, in this order; ``group_id`` is its doc.
    """
    before = Window.partitionBy("doc").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, 0)
    first = F.coalesce(F.col("start") >= F.max(F.col("start") + F.col("n")).over(before), F.lit(True))
    places = _sides(found).withColumn("at", F.when(first, F.col("start"))).withColumn("at", F.last("at", ignorenulls=True).over(upto))
    nodes = places.select("doc", "at").distinct().orderBy("doc", "at").withColumn("node", F.monotonically_increasing_id())
    nodes = stored(nodes, "passages-nodes")
    places = stored(places.join(nodes, ["doc", "at"]).select("doc", "start", "n", "node"), "passages-places")
    one = places.select(F.col("doc").alias("a"), F.col("start").alias("start_a"), F.col("n").alias("words_a"), F.col("node").alias("na"))
    two = places.select(F.col("doc").alias("b"), F.col("start").alias("start_b"), F.col("n").alias("words_b"), F.col("node").alias("nb"))
    edges = found.join(one, ["a", "start_a", "words_a"]).join(two, ["b", "start_b", "words_b"]).select(F.col("na").alias("a"), F.col("nb").alias("b"))
    named = components(edges, "passages-groups").withColumnRenamed("component", "group")
    named = named.join(nodes.select(F.col("node").alias("group"), F.col("doc").alias("group_id")), "group")
    return stored(places.join(named, "node").select("doc", "start", "n", "group", "group_id"), "passages-grouped")


def _open(windows: DataFrame, groups: DataFrame) -> DataFrame:
    """``key, doc, span, group`` of windows whose key has more than one group; windows in no passage are their text's."""
    held = _held(groups)
    begin, end = _first(F.col("span")), _last(F.col("span")) + 1
    shared = F.transform("held", lambda p: F.struct((F.least(end, p["start"] + p["n"]) - F.greatest(begin, p["start"])).alias("words"), p["group"].alias("group")))
    best = F.array_max(shared)
    placed = windows.join(held, "doc", "left").select("key", "doc", "span", F.when(best["words"] >= INSIDE, best["group"]).otherwise(_own("doc")).alias("group"))
    placed = stored(placed, "passages-placed")
    keys = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("group").alias("_least"), F.max("group").alias("_most"))
    return stored(placed.join(keys.filter("n > 2 and _least != _most").select("key"), "key"), "passages-open")


def _held(groups: DataFrame) -> DataFrame:
    """``doc, held``: the passages of each text, without those inside another one, which are of its group and tell nothing more."""
    before = Window.partitionBy("doc").orderBy("start", F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.max(F.col("start") + F.col("n")).over(before)
    groups = groups.withColumn("_ahead", ahead).filter("_ahead is null or start + n > _ahead")
    return groups.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "group")).alias("held"))


def _own(doc: str) -> Column:
    """The group of what lies in no passage of a text."""
    return -1 - F.shiftrightunsigned(F.xxhash64(doc), 1)


def _zoned(windows: DataFrame, groups: DataFrame, texts: DataFrame) -> DataFrame:
    """``doc, span, spare, tokens, groups``: shingles around windows, as far as they are compared, with the groups they lie in.

    Overlapping windows of a text are one zone. A passage has 46 tokens, so two zones that share one share 37 different
    shingles (fewer by as many as a text repeats in 46); ``spare`` is one less.
    """
    spans = windows.select("doc", _first(F.col("span")).alias("begin"), _last(F.col("span")).alias("end")).distinct()
    order = Window.partitionBy("doc").orderBy("begin", "end")
    first = F.coalesce(F.col("begin") > F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    zones = spans.withColumn("_zone", first).withColumn("_zone", F.sum("_zone").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    zones = zones.groupBy("doc", "_zone").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    zones = zones.select("doc", F.shiftleft("begin", 32).bitwiseOR(F.col("end")).alias("span"), _own("doc").alias("own"))
    full = zones.join(texts, "doc").join(_held(groups), "doc", "left")
    return stored(full.mapInArrow(_zones, "doc bigint, span bigint, spare int, tokens array<bigint>, groups array<bigint>"), "passages-zones")


def _rare(zones: DataFrame) -> DataFrame:
    """``token, doc, span, group, main`` of shingles by which zones are to meet.

    In the order of how many zones hold them, the rarest of the shingles that a passage shares is not among the last
    ``spare`` of either zone; these are left out. So are shingles that lie in one group wherever they are: what is found
    by them is in that group already. ``main`` is the group that a shingle mostly lies in.
    """
    every = zones.select("doc", "span", "spare", F.explode(F.arrays_zip("tokens", "groups")).alias("t"))
    every = every.select("doc", "span", "spare", F.col("t.tokens").alias("token"), F.col("t.groups").alias("group"))
    several = every.groupBy("token").agg(F.count(F.lit(1)).alias("times"), F.min("group").alias("_least"), F.max("group").alias("_most"))
    several = several.filter("_least != _most").select("token", "times")
    rank = F.dense_rank().over(Window.partitionBy("doc", "span").orderBy(F.desc("times"), F.desc("token")))
    rare = stored(every.join(several, "token").withColumn("_rank", rank).filter("_rank > spare").select("token", "doc", "span", "group"), "passages-rare")
    main = rare.groupBy("token", "group").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(F.max_by("group", F.struct("n", "group")).alias("main"))
    return rare.join(main, "token")


def _alike(pairs: DataFrame, zones: DataFrame) -> DataFrame:
    """Pairs of zones that share as many shingles as a passage does, not counting those that lie in the same group.

    A passage over a shingle that lies in one group on both sides belongs to that group, whether it is listed or not.
    The shingles of a zone go to each of its pairs, so pairs are taken in parts, by their first zone.
    """
    pairs = stored(pairs, "passages-near")
    parts = _parts(pairs, zones)
    return _together([stored(_alike_part(pairs, zones, _mine(i, parts, "doc", "span")), "passages-alike") for i in range(parts)])


def _alike_part(pairs: DataFrame, zones: DataFrame, mine: Column) -> DataFrame:
    held = zones.select("doc", "span", "spare", "tokens", "groups")
    other = held.select(*[F.col(c).alias(n) for c, n in zip(held.columns, ("twin", "twin_span", "_spare", "_tokens", "_groups"), strict=True)])
    both = pairs.filter(mine).join(held.filter(mine), ["doc", "span"]).join(other, ["twin", "twin_span"])
    # Marks of shingle and group are made behind the joins: groups repeat and so take less room on the way.
    marks = [F.zip_with(t, g, lambda t, g: F.xxhash64(t, g)) for t, g in (("tokens", "groups"), ("_tokens", "_groups"))]
    least, shared = F.greatest("spare", "_spare"), F.size(F.array_intersect("tokens", "_tokens"))
    return both.filter(F.when(shared > least, shared - F.size(F.array_intersect(*marks)) > least)).select("doc", "span", "twin", "twin_span")


def _chained(rare: DataFrame) -> DataFrame:
    """Each zone with a shingle and the one before, where the shingle lies in two groups."""
    before = F.lag(F.struct("doc", "span", "group")).over(Window.partitionBy("token").orderBy("doc", "span", "group"))
    ends = rare.withColumn("before", before).filter("before is not null and before.group != group")
    return _once(ends.select("doc", "span", F.col("before.doc").alias("twin"), F.col("before.span").alias("twin_span")))


def _crossed(rare: DataFrame) -> DataFrame:
    """All pairs of zones that share a shingle that lies in two groups; one of them is not its main group."""
    other = rare.select("token", F.col("doc").alias("twin"), F.col("span").alias("twin_span"), F.col("group").alias("_group"))
    pairs = rare.filter("group != main").join(other, "token").filter("group != _group and doc != twin")
    return _once(pairs.select("doc", "span", "twin", "twin_span"))


def _once(pairs: DataFrame) -> DataFrame:
    """Each two zones once, whichever of them comes first."""
    sides = F.struct("doc", "span"), F.struct(F.col("twin").alias("doc"), F.col("twin_span").alias("span"))
    ends = pairs.select(F.greatest(*sides).alias("x"), F.least(*sides).alias("y"))
    return ends.select("x.doc", "x.span", F.col("y.doc").alias("twin"), F.col("y.span").alias("twin_span")).distinct()


def _zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each zone its different shingles with their groups, and how many of the commonest of them tell nothing."""
    for batch in batches:
        out: list[list] = [[], [], []]
        docs, spans, owns, texts_, passages_ = batch.columns
        for doc, span, own, held, known in zip(docs.to_pylist(), spans.to_pylist(), owns.to_pylist(), texts_, passages_.to_pylist(), strict=True):
            begin = max((span >> 32) - MARGIN, 0)
            every = np.frombuffer(held.as_buffer(), np.uint64)[begin : (span & 0xFFFFFFFF) + MARGIN + 1]
            group = np.full(len(every), own)
            for p in known or ():
                group[max(p["start"] - begin, 0) : max(p["start"] + p["n"] - WIDTH + 1 - begin, 0)] = p["group"]
            # Tokens that stand less than a passage ahead as well, at most in one stretch of that length.
            order = np.argsort(every, kind="stable")
            near = np.zeros(len(every), bool)
            near[order[1:]] = (every[order[1:]] == every[order[:-1]]) & (order[1:] - order[:-1] < LEAST_TOKENS)
            sums = in_order(near)
            again = int((sums[LEAST_TOKENS:] - sums[:-LEAST_TOKENS]).max(initial=0))
            spare = max(-(-PERCENT * (LEAST_TOKENS - again) // 100) - 1, 0)
            order = np.lexsort((every, group))  # equal groups side by side take little room
            every, group = every[order], group[order]
            new = np.ones(len(every), bool)
            new[1:] = (every[1:] != every[:-1]) | (group[1:] != group[:-1])
            for column, x in zip(out, (spare, every[new].view(np.int64), group[new]), strict=True):
                column.append(x)
        yield pa.RecordBatch.from_arrays(
            [docs, spans, pa.array(out[0], pa.int32()), *[pa.array(x, pa.list_(pa.int64())) for x in out[1:]]],
            names=["doc", "span", "spare", "tokens", "groups"],
        )


def _result(found: DataFrame, groups: DataFrame, copies: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    side = found.select(F.col("a").alias("doc"), F.col("start_a").alias("start"), F.col("words_a").alias("n"),
                        F.col("b").alias("twin"), F.col("start_b").alias("twin_start"), "similarity")
    other = found.select("b", "start_b", "words_b", "a", "start_a", "similarity")
    # The same passage can come from two rounds.
    every = side.unionAll(other).distinct().join(groups, ["doc", "start", "n"])
    every = every.select("doc", "start", "n", "twin", "twin_start", "similarity", F.lit(False).alias("whole"), "group_id")
    # Of whole copies only the length is missing; it is the same for the first and all others.
    next_ = copies.groupBy("first").agg(F.min("doc").alias("twin"))
    pairs = copies.select("doc", F.col("first").alias("twin"), F.col("first").alias("group_id"))
    pairs = pairs.unionAll(next_.select(F.col("first").alias("doc"), "twin", F.col("first").alias("group_id")))
    length = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    whole = narrowed(rows, pairs, "doc").join(pairs, "doc").select("doc", F.lit(0), length.alias("n"), "twin", F.lit(0), F.lit(1.0), F.lit(True), "group_id").filter(F.col("n") >= MIN_WORDS)
    best = F.min(F.struct("twin", "twin_start", "similarity"))
    grouped = every.unionAll(whole).groupBy("doc", "start", "n", "whole").agg(best.alias("t"), F.count(F.lit(1)).alias("n_twins"), F.min("group_id").alias("group_id"))
    return grouped.select(
        F.col("doc").alias(id_col), F.col("start").alias("start_word"), F.col("n").alias("n_words"),
        F.col("t.twin").alias("twin_id"), F.col("t.twin_start").alias("twin_start"), "n_twins",
        F.col("t.similarity").alias("similarity"), "whole", "group_id",
    )


# ---- compact windows ----------------------------------------------------------------------------------------------


def running_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each stretch of ``width`` values, in time proportional to their number times log(width)."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def compact_windows(tokens: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, text, first and last token of the compact windows of a chunk of texts, for all bands."""
    n = np.diff(offs)
    starts = np.maximum(n - width + 1, 0)
    row = np.repeat(np.arange(len(n)), starts)
    if not len(row):
        return np.zeros(0, np.uint64), row, row, row
    at = offs[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for band in range(BANDS):
        least = [running_minima(tokens * _TIMES[2 * band + k], width)[at] for k in range(2)]
        new = np.ones(len(row), bool)
        new[1:] = (least[0][1:] != least[0][:-1]) | (least[1][1:] != least[1][:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(row)] - 1
        out[0].append(mix(least[0][first] * np.uint64(2 * band + 3) + mix(least[1][first])))
        out[1].append(row[first])
        out[2].append(at[first] - offs[:-1][row[first]])
        out[3].append(at[last] - offs[:-1][row[last]] + width - 1)
    return tuple(np.concatenate(x) for x in out)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        flat, offs = text_bytes(batch.column(1))
        for a, _, own, own_offs in chunks(flat, offs):
            words, at = word_hashes(own, own_offs, lower=True)
            tokens, at = shingle_hashes(words, at, WIDTH, whole=False)
            key, row, first, last = compact_windows(tokens, at, WINDOW)
            span = (first << 32) | (last + WIDTH - 1)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[row + a]), pa.array(span)], names=["key", "doc", "span"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: those of a key of several windows, each with the first of them. Keeps two rows at a time."""
    lead = None  # (key, doc, span, whether it has gone on)
    for batch in batches:
        key, doc, span = (batch.column(i).to_numpy() for i in range(3))
        if not len(key):
            continue
        go = np.ones(len(key), bool)
        if lead is not None:
            key, doc, span = (np.r_[np.array([x]), y] for x, y in zip(lead[:3], (key, doc, span), strict=True))
            go = np.r_[not lead[3], go]
        same = key[1:] == key[:-1]
        again = np.r_[False, same]
        at = np.maximum.accumulate(np.where(again, 0, np.arange(len(key))))
        several = again | np.r_[same, False]
        here = np.flatnonzero(several & go)
        there = at[here]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[here], doc[here], span[here], doc[there], span[there])], names=["key", "doc", "span", "lead", "lead_span"])
        # The first of the last key waits for the next rows.
        k = int(at[-1])
        lead = (key[k], doc[k], span[k], bool(several[k]) or not go[k])


# ---- verification -------------------------------------------------------------------------------------------------


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offs = text_bytes(batch.column(1))
        for a, b, own, own_offs in chunks(flat, offs):
            tokens, at = shingle_hashes(*word_hashes(own, own_offs, lower=True), WIDTH, whole=False)
            held = [tokens[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(held, pa.binary())], names=["doc", "tokens"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        links = batch.column(2)
        spans = [links.flatten().field(i).to_numpy() for i in range(2)]
        ends = np.diff(links.offsets.to_numpy()).cumsum()
        cells = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), batch.column(4), batch.column(5).to_pylist(), batch.column(6).to_pylist())
        for i, (a, b, ta, tb, at_a, at_b) in enumerate(zip(*cells, strict=True)):
            part = slice(ends[i - 1] if i else 0, ends[i])
            left, right = np.frombuffer(ta.as_buffer(), np.uint64), np.frombuffer(tb.as_buffer(), np.uint64)
            near = [s[part] - ((at << 32) | at) for s, at in zip(spans, (at_a, at_b), strict=True)]  # links counted from the first token that came along
            out += [(a, x[0] + at_a, x[1], b, x[2] + at_b, *x[3:]) for x in _shared(left, right, *near)]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
        columns = list(zip(*out, strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["a", "start_a", "words_a", "b", "start_b", "words_b", "similarity"],
        )


def passages(left: np.ndarray, right: np.ndarray, spans_left: np.ndarray, spans_right: np.ndarray) -> list[tuple]:
    """(start, words, start, words, similarity) of the passages that two texts share, given links of their windows."""
    return _shared(*(shingle_hashes(w, np.array([0, len(w)]), WIDTH, whole=False)[0] for w in (left, right)), spans_left, spans_right)


def _shared(ta: np.ndarray, tb: np.ndarray, spans_left: np.ndarray, spans_right: np.ndarray) -> list[tuple]:
    """As :func:`passages`, from the tokens of both texts."""
    found = set()
    for a0, a1, b0, b1 in _regions(spans_left, spans_right):
        a0, b0 = max(a0 - MARGIN, 0), max(b0 - MARGIN, 0)
        part_a, part_b = ta[a0 : a1 + MARGIN], tb[b0 : b1 + MARGIN]
        for x in _aligned(part_a, part_b):
            found.add((x[0] + a0, x[1] - x[0] + WIDTH, x[2] + b0, x[3] - x[2] + WIDTH, round(x[4], 6)))
    return sorted(tuple(int(v) if i < 4 else float(v) for i, v in enumerate(x)) for x in found)


def _regions(spans_a: np.ndarray, spans_b: np.ndarray) -> list[list[int]]:
    """Links whose intervals overlap, or nearly do, in both texts, joined."""
    out: list[list[int]] = []
    rows = sorted((int(x) >> 32, int(x) & 0xFFFFFFFF, int(y) >> 32, int(y) & 0xFFFFFFFF) for x, y in zip(spans_a, spans_b, strict=True))
    for a0, a1, b0, b1 in rows:
        for r in reversed(out):
            if a0 <= r[1] + MARGIN and b0 <= r[3] + MARGIN and b1 >= r[2] - MARGIN:
                r[1], r[2], r[3] = max(r[1], a1), min(r[2], b0), max(r[3], b1)
                break
        else:
            out.append([a0, a1, b0, b1])
    return out


def _aligned(ta: np.ndarray, tb: np.ndarray) -> Iterator[tuple]:
    """Passages of two regions. All places of a shingle count: runs of matches on one diagonal are seeds, longest first.

    A seed is extended both ways over the runs that continue it. A further passage needs room that is new in one of
    the texts, as many tokens in a row as a passage has, or texts that repeat themselves would give each shift of a
    passage again. Matches are listed ``PAIRS`` at a time, so memory follows the regions' length.
    """
    # Equal tokens as equal small numbers.
    n_tokens, numbers = _numbered(ta, tb)
    ta, tb = numbers[: len(ta)], numbers[len(ta) :]
    likeness = _Likeness(ta, tb, n_tokens)
    if not likeness.anywhere():
        return
    at_a, at_b = _common(ta, tb, n_tokens)
    if not len(at_a):
        return
    order = at_b[np.argsort(tb[at_b], kind="stable")]
    room_a, room_b, seen = _Room(len(ta)), _Room(len(tb)), set()
    reach_a, reach_b = _Reach(at_a, len(ta), GAP), _Reach(at_b, len(tb), 2 * GAP + 1)
    while len(at_a) and (room_a.left or room_b.left):
        # Of a token without room, only places with room are of interest.
        free = order[room_b.free[order]]
        low, high = (np.searchsorted(tb[order], ta[at_a], side=x) for x in ("left", "right"))
        low_free, high_free = (np.searchsorted(tb[free], ta[at_a], side=x) for x in ("left", "right"))
        n = np.where(~room_a.free[at_a], high_free - low_free, high - low)
        take = max(int(np.searchsorted(np.cumsum(n), PAIRS, side="right")), 1)
        here, n = at_a[:take], n[:take]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i, old = np.repeat(here, n), np.repeat(~room_a.free[here], n)
        j = np.zeros(len(i), np.int64)
        j[old] = free[(np.repeat(low_free[:take], n) + within)[old]]
        j[~old] = order[(np.repeat(low[:take], n) + within)[~old]]
        at_a = at_a[take:]
        by = np.lexsort((i, j - i))
        i, j = i[by], j[by]
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] - i[:-1] != 1) | (j[1:] - j[:-1] != 1)
        start, end = _between(np.flatnonzero(new)[1:], len(i))
        size = end - start if len(i) else start[:0]
        start = start[: len(size)]
        runs = sorted(zip((-size).tolist(), i[start].tolist(), j[start].tolist(), strict=True), key=lambda r: r[0])
        for m, x, y in runs:
            # New room of a passage lies in one of its runs for more than this, or for the whole of a short run.
            least = min(-m, LEAST_ROOM)
            if (x, y) in seen or (room_a.within(x, x - m) < least and room_b.within(y, y - m) < least):
                continue
            a0, a1, b0, b1 = _limits(reach_a, reach_b, x, y, -m)
            if room_a.within(a0, a1) < LEAST_TOKENS and room_b.within(b0, b1) < LEAST_TOKENS:
                continue
            back = [(len(ta) - u - r, len(tb) - v - r, r) for u, v, r in _followed(ta[::-1], tb[::-1], len(ta) - 1 - x, len(tb) - 1 - y)]
            chain = [*back[:0:-1], (back[0][0], back[0][1], back[0][2] - 1), *_followed(ta, tb, x, y)]
            seen.update((u, v) for u, v, _ in chain)
            a0, a1, b0, b1 = chain[0][0], chain[-1][0] + chain[-1][2], chain[0][1], chain[-1][1] + chain[-1][2]
            if a1 - a0 < LEAST_TOKENS or not (room_a.holds(a0, a1) or room_b.holds(b0, b1)):
                continue
            own_a, own_b = (np.concatenate([np.arange(r[side], r[side] + r[2]) for r in chain]) for side in (0, 1))
            if not likeness.along(own_a, own_b):
                continue
            for f in _dense(ta, tb, own_a, own_b, n_tokens):
                if room_a.holds(f[0], f[1] + 1) or room_b.holds(f[2], f[3] + 1):
                    room_a.take(f[0], f[1] + 1)
                    room_b.take(f[2], f[3] + 1)
                    yield f


class _Reach:
    """How far a passage can go from a place of a text: matched tokens near it, and the stretch of them it lies in."""

    def __init__(self, at: np.ndarray, n: int, gap: int):
        held = np.zeros(n, bool)
        held[at] = True
        self.sums, self.n = _sums(held), n
        self.first, self.last = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if len(at):
            cuts = np.flatnonzero(at[1:] - at[:-1] > gap) + 1
            first, last = _between(cuts, len(at))
            self.first[at] = np.repeat(at[first], last - first)
            self.last[at] = np.repeat(at[last - 1] + 1, last - first)

    def near(self, a: int, b: int) -> bool:
        return self.sums[min(b, self.n)] > self.sums[max(a, 0)]


def _limits(in_a: _Reach, in_b: _Reach, x: int, y: int, m: int) -> tuple[int, int, int, int]:
    """Ends in both texts that no passage through a run of ``m`` tokens goes beyond."""
    a0, a1, b0, b1 = x, x + m, y, y + m
    if in_a.near(x - GAP, x) and in_b.near(y - 2 * GAP, y):
        a0, b0 = int(in_a.first[x]), int(in_b.first[y])
    if in_a.near(x + m, x + m + GAP) and in_b.near(y + m, y + m + 2 * GAP):
        a1, b1 = int(in_a.last[x]), int(in_b.last[y])
    return a0, a1, b0, b1


class _Room:
    """The tokens of a text that lie in a stretch of tokens not yet in a passage, as long as a passage is."""

    def __init__(self, n: int):
        self.done, self.free = np.zeros(n, bool), np.full(n, n >= LEAST_TOKENS)
        self.sums = list(range(n + 1)) if n >= LEAST_TOKENS else [0] * (n + 1)
        self.left = n >= LEAST_TOKENS

    def _count(self) -> None:
        first, last = _edges(~self.done)
        self.free = np.zeros(len(self.done), bool)
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            self.free[a:b] = b - a >= LEAST_TOKENS
        self.sums = _sums(self.free)
        self.left = bool(self.sums[-1])

    def take(self, a: int, b: int) -> None:
        self.done[a:b] = True
        self._count()

    def within(self, a: int, b: int) -> int:
        """How many tokens from ``a`` to ahead of ``b`` have room."""
        return self.sums[b] - self.sums[a]

    def holds(self, a: int, b: int) -> bool:
        """Whether a stretch of them inside is as long as a passage."""
        if self.sums[b] - self.sums[a] < LEAST_TOKENS:
            return False
        first, last = _edges(self.free[a:b])
        return bool((last - first >= LEAST_TOKENS).any())


def _edges(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of True begin, and where they have ended."""
    wide = np.zeros(len(held) + 2, bool)
    wide[1:-1] = held
    edges = np.flatnonzero(wide[1:] != wide[:-1])
    return edges[::2], edges[1::2]


def _sums(held: np.ndarray) -> list[int]:
    """How many are True ahead of each place, and in all."""
    return in_order(held).tolist()


def _between(cuts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First places of the parts that some cuts leave, and the places behind their last."""
    bounds = np.zeros(len(cuts) + 2, np.int64)
    bounds[1:-1], bounds[-1] = cuts, n
    return bounds[:-1], bounds[1:]


def _numbered(ta: np.ndarray, tb: np.ndarray) -> tuple[int, np.ndarray]:
    """How many different tokens there are, and the numbers of both texts' tokens, one text behind the other."""
    found, numbers = np.unique(np.concatenate([ta, tb]), return_inverse=True)
    return len(found), numbers


class _Likeness:
    """Bounds from above on how similar stretches of two texts are, by running sums.

    Tokens that the other text has count for it at every place, others against it only where they occur once.
    """

    def __init__(self, ta: np.ndarray, tb: np.ndarray, n_tokens: int):
        times_a, times_b = np.bincount(ta, minlength=n_tokens), np.bincount(tb, minlength=n_tokens)
        lost_a, lost_b = (times_a == 1) & (times_b == 0), (times_b == 1) & (times_a == 0)
        self.lost_a, self.lost_b = in_order(lost_a[ta] * -PERCENT), in_order(lost_b[tb] * -PERCENT)
        self.a, self.b = self.lost_a + in_order((times_b > 0)[ta] * (100 - PERCENT)), self.lost_b + in_order((times_a > 0)[tb] * (100 - PERCENT))

    def anywhere(self) -> bool:
        """Whether both texts have a stretch of a passage's tokens that may do."""
        return all(len(s) > LEAST_TOKENS and bool((s[LEAST_TOKENS:] >= np.minimum.accumulate(s[:-LEAST_TOKENS])).any()) for s in (self.a, self.b))

    def along(self, at_a: np.ndarray, at_b: np.ndarray) -> bool:
        """Whether a stretch of a chain of matches may do, with what lies between them in both texts."""
        ahead = np.searchsorted(at_a, at_a - (LEAST_TOKENS - 1), side="right")
        last = np.flatnonzero(ahead)
        if not len(last):
            return False
        for one, two in ((self.a, self.lost_b), (self.lost_a, self.b)):
            least = np.minimum.accumulate(one[at_a] + two[at_b])
            if not (one[at_a[last] + 1] + two[at_b[last] + 1] >= least[ahead[last] - 1]).any():
                return False
        return True


def _common(ta: np.ndarray, tb: np.ndarray, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of both texts that can be in a passage: equal tokens in a long enough stretch of such, in either text."""
    at_a, at_b = np.arange(len(ta)), np.arange(len(tb))
    while True:
        there = np.zeros(n_tokens, bool)
        there[tb[at_b]] = True
        left = _stretches(at_a[there[ta[at_a]]], GAP)
        there = np.zeros(n_tokens, bool)
        there[ta[left]] = True
        # From one run to the next the second text may go on by a gap more than the first.
        right = _stretches(at_b[there[tb[at_b]]], 2 * GAP + 1)
        if len(left) == len(at_a) and len(right) == len(at_b):
            return left, right
        at_a, at_b = left, right


def _stretches(at: np.ndarray, gap: int) -> np.ndarray:
    """Those of the matched tokens that lie in a stretch without a wide gap that has the words of a passage."""
    if not len(at):
        return at
    cuts = np.flatnonzero(at[1:] - at[:-1] > gap) + 1
    first, last = _between(cuts, len(at))
    long = at[last - 1] - at[first] + WIDTH >= MIN_WORDS
    return at if long.all() else at[np.repeat(long, last - first)]


def _run(ta: np.ndarray, tb: np.ndarray, i: int, j: int, most: int | None = None) -> int:
    """How many tokens are equal from two places on."""
    n, step, end = 0, 64, min(len(ta) - i, len(tb) - j, most or len(ta))
    while n < end:
        same = ta[i + n : i + min(n + step, end)] == tb[j + n : j + min(n + step, end)]
        first = int(same.argmin())
        if not same[first]:
            return n + first
        n, step = n + len(same), step * 2
    return end


def _followed(ta: np.ndarray, tb: np.ndarray, i: int, j: int) -> list[tuple[int, int, int]]:
    """Runs (place, place, tokens) from two equal tokens on: at the end of one the run close by that continues it best."""
    out = []
    while True:
        n = _run(ta, tb, i, j)
        out.append((i, j, n))
        i, j = i + n, j + n
        if i >= len(ta) or j >= len(tb):
            return out
        first: dict[int, int] = {}  # the first match of each diagonal
        x, y = (ta[i : i + GAP, None] == tb[None, j : j + 2 * GAP]).nonzero()
        for x, y in zip(x.tolist(), y.tolist(), strict=True):
            if abs(y - x) <= GAP:
                first.setdefault(y - x, x)
        if not first:
            return out
        if len(first) > 1:
            worth = [(_run(ta, tb, i + x, j + x + d, 2 * MIN_WORDS) - x - abs(d), -x, -d) for d, x in first.items()]
            _, x, d = max(worth)
            i, j = i - x, j - x - d
        else:
            ((d, x),) = first.items()
            i, j = i + x, j + x + d


def _dense(ta: np.ndarray, tb: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, n_tokens: int) -> Iterator[tuple]:
    """Stretches of matches without a wide gap whose shingle sets are similar enough; others are cut at their widest gap."""
    steps, shifts = at_a[1:] - at_a[:-1], np.abs((at_b[1:] - at_b[:-1]) - (at_a[1:] - at_a[:-1]))
    cuts = np.flatnonzero((steps > GAP) | (shifts > GAP)) + 1
    steps += shifts
    todo = [(x, y) for x, y in zip(np.r_[0, cuts], np.r_[cuts, len(at_a)], strict=True)]
    while todo:
        x, y = todo.pop()
        if y - x < 1 or at_a[y - 1] - at_a[x] + WIDTH < MIN_WORDS:
            continue
        a0, a1, b0, b1 = int(at_a[x]), int(at_a[y - 1]), int(at_b[x]), int(at_b[y - 1])
        held = np.zeros(n_tokens, np.uint8)
        held[ta[a0 : a1 + 1]] = 1
        held[tb[b0 : b1 + 1]] |= 2
        _, one, two, both = np.bincount(held, minlength=4).tolist()
        if 100 * both >= PERCENT * (one + two + both):
            if b1 - b0 + WIDTH >= MIN_WORDS:
                yield a0, a1, b0, b1, both / (one + two + both)
            continue
        gaps = steps[x : y - 1]
        if len(gaps) and gaps.max() > 1:
            m = x + int(np.argmax(gaps)) + 1
            todo += [(x, m), (m, y)]
