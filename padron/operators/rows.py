"""Row cuts and filters.

Cuts follow the order of rows inside a sheet without bringing a sheet into one task: the cut position is
an aggregate with map-side combine, and is then attached to the rows as a lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.functions import cells
from padron.operators.joins import lookup_join
from padron.session import col, shared_folder
from padron.sources.specs import FilterSpec

SHEET = ("file", "sheet")
ORDER = "row_idx"
# Buckets of a blank-run summary that one window task orders; the next level orders these blocks.
BLOCK_BUCKETS = 4096
FOOTER_LENGTH = 20


def keep_before(df: DataFrame, cuts: DataFrame, keys: Sequence[str] = SHEET, order: str = ORDER) -> DataFrame:
    """Rows ahead of their group's ``_cut`` position; groups without one are kept whole."""
    marked = lookup_join(df, cuts, keys)
    return marked.filter(F.col("_cut").isNull() | (col(order) < F.col("_cut"))).drop("_cut")


def stop_at_first(df: DataFrame, stop: Column, keys: Sequence[str] = SHEET, order: str = ORDER) -> DataFrame:
    """Everything before the first row where ``stop`` holds."""
    cuts = df.filter(stop).groupBy(*keys).agg(F.min(order).alias("_cut"))
    return keep_before(df, cuts, keys, order)


def blank_run_cuts(
    df: DataFrame, has_key: Column, limit: int, keys: Sequence[str] = SHEET, order: str = ORDER
) -> DataFrame:
    """First keyed row that follows ``limit`` or more rows without a key (blanks ahead of all keys do not count).

    Two keyed rows of one ``limit``-wide bucket are never that far apart, so first and last keyed row per
    bucket are enough. Buckets are compared inside blocks, then blocks inside the sheet.
    """
    keys = list(keys)
    bucket = F.floor(col(order) / F.lit(limit))
    spans = (
        df.filter(has_key)
        .groupBy(*keys, bucket.alias("_bucket"))
        .agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
        .withColumn("_block", F.floor(F.col("_bucket") / F.lit(BLOCK_BUCKETS)))
        .withColumn("_cut", F.lit(None).cast("bigint"))
    )
    for within, by in (([*keys, "_block"], "_bucket"), (keys, "_block")):
        before = F.lag("_hi").over(Window.partitionBy(*within).orderBy(by))
        jump = F.when(F.col("_lo") - before > limit, F.col("_lo"))
        spans = (
            spans.withColumn("_cut", F.least(F.col("_cut"), jump))
            .groupBy(*within)
            .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.min("_cut").alias("_cut"))
        )
    return spans.filter(F.col("_cut").isNotNull()).select(*keys, "_cut")


def stop_after_blank_run(
    df: DataFrame, key: Column, limit: int = 1000, keys: Sequence[str] = SHEET, order: str = ORDER
) -> DataFrame:
    """Rows with a key, up to the first long run of rows without one."""
    has_key = cells.has_text(key)
    return keep_before(df.filter(has_key), blank_run_cuts(df, has_key, limit, keys, order), keys, order)


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with their place in a total order, counted from 1.

    Rows are dealt by ranges of the order and numbered inside each; the ranges' sizes, one row each, give the
    offsets. Between the two steps the rows are stored, so that both see the same ranges.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    path = shared_folder(spark, "numbered")
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path).withColumn("_range", F.shiftright("_at", 33))
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(F.broadcast(offsets), "_range").withColumn(name, inside + F.col("_before") + 1).drop("_range", "_at", "_before")


def drop_blank_key(df: DataFrame, key: Column) -> DataFrame:
    return df.filter(cells.has_text(key))


def drop_null_key(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.filter(col(name).isNotNull())
    return df


def drop_empty_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drops rows in which every column (but the ignored ones) is null.

    The outcome is carried in a column the optimizer does not move. As a predicate over many renamed columns, be it
    a coalesce or a test of an array, it would make the optimizer's inference of further predicates grow
    exponentially (measured: planning the income flow then takes minutes).
    """
    values = [col(c).cast("string") for c in df.columns if c not in ignore]
    filled = F.when(F.coalesce(*values).isNotNull(), F.spark_partition_id())
    return df.withColumn("_filled", filled).filter(F.col("_filled").isNotNull()).drop("_filled")


def is_data_row(first_cell: Column, footer_length: int = FOOTER_LENGTH) -> Column:
    """Neither an empty row nor a footer: the first cell is set, and is not a text longer than ``footer_length``."""
    footer = ~cells.looks_numeric(first_cell) & (F.length(first_cell) > footer_length)
    return F.coalesce(first_cell.isNotNull() & ~footer, F.lit(False))


def declared_filters(df: DataFrame, filters: Sequence[FilterSpec]) -> tuple[DataFrame, list[str]]:
    """Applies a declared filter list; filters on unknown columns are skipped and reported."""
    skipped = []
    for f in filters:
        if f.column not in df.columns:
            skipped.append(f.column)
            continue
        c = col(f.column)
        tests = {
            "NOT_EQUAL": c != F.lit(f.value),
            "EQUAL": c == F.lit(f.value),
            "IS_NOT_NULL": c.isNotNull(),
            "IS_NULL": c.isNull(),
        }
        if f.condition in tests:
            df = df.filter(tests[f.condition])
    return df, skipped


def split_by_text(df: DataFrame, column: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows that contain the text, rows that do not); a null value is in neither."""
    if column not in df.columns:
        raise ValueError(f"column '{column}' is missing")
    found = col(column).contains(text)
    return df.filter(found), df.filter(~found)
