"""Cost-centre catalogues: keep-first deduplication, prioritised merge, enrichment with match status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.functions.calendar import match_status
from padron.operators.joins import BROADCAST_ROWS, lookup_join
from padron.session import col


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; a null key is a key like any other.

    The rank test lets Spark keep one row per key in every map task before the shuffle, so a key that
    fills a large part of the table still arrives as one row per task.
    """
    ranked = Window.partitionBy(*[col(k) for k in key]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return first_per_key(df, [key], [col(o).asc() for o in order])


def merge_by_priority(sources: Sequence[DataFrame], key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: from the earliest source that has it, and there the first by ``order``."""
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    merged = tagged[0]
    for t in tagged[1:]:
        merged = merged.unionByName(t)
    ranks = [F.col("_source").asc(), *[col(o).asc() for o in order]]
    return first_per_key(merged, [key], ranks).drop("_source")


def enrich_with_catalogue(
    df: DataFrame,
    catalogue: DataFrame,
    code: str,
    key: str,
    values: Mapping[str, str],
    status: str = "status_match",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join by code; ``values`` maps catalogue columns (the key included) to output names."""
    lookup = catalogue.select(
        col(key).alias(code), *[col(old).alias(new) for old, new in values.items()], col(key).alias("_found")
    )
    joined = lookup_join(df, lookup, [code], max_rows=max_rows)
    return joined.withColumn(status, match_status(col(code), F.col("_found"))).drop("_found")
