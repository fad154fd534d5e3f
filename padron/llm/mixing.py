"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every document has a rate: how often the mix takes it. Of all rates that give each source its target number of
words, and that stay within ``cap`` copies, the method takes those nearest in relative entropy to "every document
once". The solution is an exponential tilt in the document's size, ``min(cap, exp(lambda * size))`` with one
multiplier per source; the multipliers are the maximum of the convex dual, found by safeguarded Newton steps for
all sources at once. A step is one aggregate over the histogram of sizes, which is stored once.

Rates become whole copies by systematic rounding: within blocks of a source of about ``BLOCK_ROWS`` documents, in
order of size, the running sum of the rates' fractions is rounded, so a block misses its share by less than one
document. Everything that decides a row is exact decimal or integer arithmetic, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import n_words, stored

CAP = 3
WEIGHTS = (1, 2, 3)
BLOCK_ROWS = 1000
MAX_STEPS = 60
TOLERANCE = 1e-7
#: Rates are held in millionths, multipliers in 1e-15.
UNIT = 1_000_000


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents with ``size, source_size, target, rate, copies, taken``.

    ``docs`` needs ``doc_id, text, source``; other columns are kept, except those of the names just listed, which
    are replaced. Null or empty texts have size 0, rate 1 and one copy that takes no words. A null source is a
    source of its own, the last one. Repeated rows are documents of their own. An empty table gives an empty one.
    """
    own = ["size", "source_size", "target", "rate", "copies", "taken"]
    kept = [c for c in docs.columns if c not in own]
    sized = docs.select(*[F.col(f"`{c}`") for c in kept], n_words(F.col("text")).alias("size"))
    hist = stored(
        sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")).withColumn("words", F.expr("size * docs")),
        "mix-sizes",
    )
    rates = solve(hist, targets(hist, weights, cap), cap)
    rated = (
        sized.alias("d")
        .join(rates.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")), "left")
        .select("d.*", "r.source_size", "r.target", "r.multiplier", "r.blocks")
        .withColumn("rate", _rate(F.col("size"), F.col("multiplier"), cap))
    )
    return _rounded(rated, kept)


def targets(hist: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source: rows, size and target. Targets are shares of all words by weight, at most ``cap`` times the size.

    Sources weigh ``weights`` in turn by code point, null last. The numbering is a range partition and an offset per
    partition, so no task sees all sources. A source over its cap stops there and the rest is shared anew.
    """
    spark = hist.sparkSession
    sums = hist.groupBy("source").agg(
        F.sum("docs").alias("source_docs"),
        F.sum("words").alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"),
    )
    placed = stored(
        sums.repartitionByRange(F.col("source").isNull(), F.col("source"))
        .sortWithinPartitions(F.col("source").isNull(), F.col("source"))
        .withColumn("_id", F.monotonically_increasing_id()),
        "mix-sources",
    )
    part, within = F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")
    numbered = placed.select("*", part, within)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    )
    turn = F.pmod(F.col("_at") + F.coalesce("_before", F.lit(0)), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    sources = stored(
        numbered.join(offsets, "_part").withColumn("weight", weight).withColumn("limit", F.col("source_size") * cap)
        .drop("_id", "_part", "_at", "_n", "_before"),
        "mix-weights",
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, stopped = 0.0, -1
    while total:
        over = F.col("limit") < F.col("weight") * F.lit(level)
        now, held, free = sources.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("limit"))), F.lit(0)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if now == stopped or not free:
            break
        stopped, level = now, (total - held) / free
    share = F.least(F.col("limit").cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.withColumn("target", share)


def solve(hist: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Per source the multiplier whose rates meet the target, by Newton steps on the dual kept within brackets.

    The dual's slope, words taken less target, rises with the multiplier. A step that leaves the bracket is
    replaced by its middle. At the upper bracket every document is at the cap.
    """
    upper = F.log(F.lit(float(cap))) / F.col("smallest")
    lower = F.lit(-60.0) / F.col("smallest")
    state = stored(
        sources.withColumn("low", lower).withColumn("high", upper)
        .withColumn("multiplier", F.when(F.col("target") >= F.col("limit"), upper).otherwise(F.lit(0.0)))
        .withColumn("done", (F.col("target") >= F.col("limit")) | F.col("smallest").isNull()),
        "mix-start",
    )
    for _ in range(MAX_STEPS):
        open_ = state.filter("not done").select(F.col("source").alias("_s"), "multiplier")
        rate = F.exp(F.col("multiplier") * F.col("size"))
        taken = F.col("words") * F.least(rate, F.lit(float(cap)))
        slope = F.when(rate < cap, F.col("words") * F.col("size") * rate).otherwise(F.lit(0.0))
        sums = (
            hist.join(open_, F.col("source").eqNullSafe(F.col("_s")))
            .groupBy("_s")
            .agg(*[F.sum(x.cast("decimal(38,6)")).cast("double").alias(n) for x, n in ((taken, "_taken"), (slope, "_slope"))])
        )
        miss = F.col("_taken") - F.col("target")
        low = F.when(miss < 0, F.greatest("low", "multiplier")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.least("high", "multiplier")).otherwise(F.col("high"))
        step = F.col("multiplier") - miss / F.when(F.col("_slope") > 0, F.col("_slope"))
        inside = (step > F.col("low")) & (step < F.col("high"))
        near = F.abs(miss) <= F.col("target") * TOLERANCE
        moved = (
            state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left")
            .withColumn("low", F.when(F.col("done"), F.col("low")).otherwise(low))
            .withColumn("high", F.when(F.col("done"), F.col("high")).otherwise(high))
            .withColumn("_next", F.when(inside, step).otherwise((F.col("low") + F.col("high")) / 2))
            .withColumn("multiplier", F.when(F.col("done") | near, F.col("multiplier")).otherwise(F.round("_next", 15)))
            .withColumn("done", F.col("done") | near)
            .drop("_s", "_taken", "_slope", "_next")
        )
        state = stored(moved, "mix-step")
        if state.filter("not done").isEmpty():
            break
    blocks = F.ceil(F.col("source_docs") / BLOCK_ROWS)
    return state.select("source", "source_size", "target", "multiplier", blocks.alias("blocks"))


def _rate(size: Column, multiplier: Column, cap: int) -> Column:
    """Copies of a document in millionths; documents without words stay as they are."""
    tilted = F.round(F.least(F.exp(multiplier * size), F.lit(float(cap))) * UNIT).cast("bigint")
    return F.when((size == 0) | multiplier.isNull(), F.lit(UNIT).cast("bigint")).otherwise(tilted)


def _rounded(rated: DataFrame, kept: list[str]) -> DataFrame:
    block = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mix")), F.col("blocks"))
    order = Window.partitionBy("source", "_block").orderBy(F.desc("size"), F.xxhash64("doc_id"), "doc_id")
    upto = F.sum(F.pmod(F.col("rate"), F.lit(UNIT))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    half = UNIT // 2
    extra = F.expr(f"(_upto + {half}) div {UNIT} - (_upto - pmod(rate, {UNIT}) + {half}) div {UNIT}")
    return (
        rated.withColumn("_block", block)
        .withColumn("_upto", upto)
        .withColumn("copies", F.expr(f"rate div {UNIT}") + extra)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target",
                (F.col("rate") / UNIT).alias("rate"), "copies", "taken")
    )


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy the mix takes; documents it takes no copy of are gone."""
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return mixed.filter("copies > 0").select(*columns, times.alias("_copy")).drop("_copy")
