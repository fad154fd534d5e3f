"""Line dedup over content-defined chunks of lines, in DataFrame operations only.

A rolling hash over the hashes of two neighbouring lines ends a chunk wherever it is divisible by ``DIVISOR``, so an
inserted or dropped line moves only the boundaries beside it. Chunks of two or more lines that are not blank are
counted over all documents by hash, without their text; of each repeated chunk the first occurrence stays, by
document id and place. A repeated block seldom begins and ends with a chunk, and a short one may hold none, so the
smallest pieces of a block, two lines that follow each other with only blank lines between, are counted in the same way:
they carry a removal from a chunk to the ends of its block. Before anything is removed, the texts of all occurrences of
a repeated hash are compared byte by byte; should two texts share a hash, each is deduplicated by itself.

So a line goes exactly if it lies in two neighbouring lines that an earlier place has, and the first place that has a
line keeps it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import stored

DIVISOR = 3
MIN_LINES = 2
BREAK = "\n"
SOLID = r"[^\x20\x09-\x0D]"


def line_dedup(docs: DataFrame, *, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """The documents with ``text`` without repeated blocks of lines, and ``n_lines, n_removed`` (lines before, lines removed).

    Lines end at line feeds. No document is dropped: one whose chunks are all repeats keeps the empty text. A null
    text stays null (no lines); a document with a null id stays as it is and counts nowhere. Rows that share an id
    are seen as one document: a chunk at the same place in both stays in both. Columns named ``n_lines`` or
    ``n_removed`` are replaced; all others stay. An empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    found = docs.filter("doc_id is not null").select("doc_id", F.explode(_chunks(F.col("text"), divisor, min_lines)).alias("c"))
    found = found.select("doc_id", "c.start", "c.stop", "c.hash")
    place = F.struct("doc_id", "start")
    repeated = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    # Stored, so that the join below deals out both sides itself and can split the rows of a chunk that very many share.
    repeated = stored(repeated, "lines-repeated")
    marks = (
        found.join(repeated, "hash")
        .select("doc_id", F.struct("start", "stop", "hash", (place == F.col("first")).alias("first")).alias("mark"))
        .groupBy("doc_id").agg(F.collect_set("mark").alias("_marks"))
    )
    marked = stored(docs.join(marks, "doc_id", "left").select(*kept, "_marks"), "lines-marked")

    lines = F.split("text", BREAK, -1)
    # Only the chunks' own text goes on from here, not the document beside each of them.
    own = _bound(
        F.struct(lines.alias("lines"), F.col("_marks").alias("marks")),
        lambda r: F.transform(
            r["marks"],
            lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), m["hash"].alias("hash"), _joined(r["lines"], m["start"], m["stop"]).alias("chunk")),
        ),
    )
    texts = marked.filter("_marks is not null").select("doc_id", F.inline(own))
    unlike = texts.groupBy("hash").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most")).filter("least != most")
    unlike = stored(unlike.select("hash"), "lines-unlike")
    cut = F.filter("_marks", lambda m: ~m["first"])
    if not unlike.isEmpty():
        same_text = texts.join(unlike, "hash").groupBy("hash", "chunk").agg(F.min(F.struct("doc_id", "start", "stop")).alias("first"))
        stays = same_text.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_set(F.struct("first.start", "first.stop")).alias("_stay"))
        marked = marked.join(stays, "doc_id", "left")
        cut = F.filter("_marks", lambda m: ~m["first"] & ~F.coalesce(F.array_contains("_stay", F.struct(m["start"], m["stop"])), F.lit(False)))
    n = F.coalesce(F.size(lines), F.lit(0))
    gone = F.array_distinct(F.flatten(F.transform(cut, lambda m: F.sequence(m["start"], m["stop"]))))
    rest = F.array_except(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), gone)
    text = _bound(
        F.struct(lines.alias("lines"), rest.alias("rest")),
        lambda r: F.array(F.array_join(F.transform(r["rest"], lambda i: F.element_at(r["lines"], i)), BREAK)),
    )[0]
    removed = F.coalesce(F.size(gone), F.lit(0))
    final = F.when(removed > 0, text).otherwise(F.col("text"))
    columns = [final.alias("text") if c == "text" else F.col(f"`{c}`") for c in kept]
    return marked.select(*columns, n.cast("bigint").alias("n_lines"), removed.cast("bigint").alias("n_removed"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """The list that ``use`` makes of a value, which is worked out once and not for each element it is used for."""
    return F.flatten(F.transform(F.array(value), use))


def _chunks(text: Column, divisor: int, min_lines: int) -> Column:
    """Chunks that may be removed, as (start, stop, hash) with lines counted from 1; null for a null text."""
    lines = F.split(text, BREAK, -1)
    row = F.struct(lines.alias("lines"), F.transform(lines, _line_hash).alias("hashes"))

    def of(row: Column) -> Column:
        lines, hashes = row["lines"], row["hashes"]
        n = F.size(lines)

        def ends(i: Column) -> Column:
            before = F.when(i > 1, F.element_at(hashes, F.greatest(i - 1, F.lit(1)))).otherwise(F.lit(0))
            return (i == n) | (F.pmod(before * 31 + F.element_at(hashes, i), F.lit(divisor)) == 0)

        stops = F.filter(F.sequence(F.lit(1), n), ends)
        solid = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at(lines, i).rlike(SOLID))
        bound = F.struct(stops.alias("stops"), solid.alias("solid"))
        return _bound(bound, lambda b: F.concat(_spans(lines, b["stops"], min_lines), _pairs(lines, b["solid"])))

    return _bound(row, of)


def _spans(lines: Column, stops: Column, min_lines: int) -> Column:
    """Chunks without the blank lines at their ends."""

    def span(stop: Column, j: Column) -> Column:
        start = F.when(j > 0, F.element_at(stops, F.greatest(j, F.lit(1))) + 1).otherwise(F.lit(1))
        inside = F.filter(F.sequence(start, stop), lambda i: F.element_at(lines, i).rlike(SOLID))
        # Beyond the least number of lines; a chunk of two is a pair of lines below.
        return F.when(F.size(inside) > min_lines, F.struct(F.array_min(inside).alias("start"), F.array_max(inside).alias("stop")))

    return _hashed(lines, F.filter(F.transform(stops, span), lambda s: s.isNotNull()))


def _pairs(lines: Column, solid: Column) -> Column:
    """Neighbouring lines that are not blank, with the blank ones between them."""
    ahead = F.slice(solid, F.lit(2), F.size(solid))
    both = F.arrays_zip(F.slice(solid, F.lit(1), F.greatest(F.size(solid) - 1, F.lit(0))).alias("start"), ahead.alias("stop"))
    return _hashed(lines, both)


def _hashed(lines: Column, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), _chunk_hash(_joined(lines, s["start"], s["stop"])).alias("hash")),
    )


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("bigint")


def _chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _slice(lines: Column, start: Column, stop: Column) -> Column:
    return F.slice(lines, start, stop - start + 1)


def _joined(lines: Column, start: Column, stop: Column) -> Column:
    return F.array_join(_slice(lines, start, stop), BREAK)
