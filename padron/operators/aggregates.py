"""Grouped text, shares, duplicates and single-pass column profiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.session import col


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; an empty whole gives 0."""
    ratio = F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.coalesce(F.round(ratio, 2), F.lit(0.0))


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    kind: str,
    outputs: Mapping[str, str],
    separator: str = " | ",
) -> DataFrame:
    """Per key, the sorted values of each kind joined to one text; ``outputs`` maps kind to column name.

    Equal values are counted before they meet, with map-side combine, so a crowded key ships one row per
    distinct value. All kinds come from one grouping.
    """
    copies = F.array_join(F.array_repeat(F.col("_value"), F.col("_times")), separator)
    counted = (
        df.filter(col(kind).isin(*outputs) & col(value).isNotNull())
        .groupBy(*[col(k) for k in keys], col(kind).alias("_kind"), col(value).alias("_value"))
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
        .withColumn("_text", F.when(F.col("_times") == 1, F.col("_value")).otherwise(copies))
    )

    def text_of(name: str) -> Column:
        entries = F.sort_array(F.collect_list(F.when(F.col("_kind") == name, F.struct("_value", "_text"))))
        return F.when(F.size(entries) > 0, F.array_join(entries["_text"], separator))

    return counted.groupBy(*[col(k) for k in keys]).agg(*[text_of(k).alias(name) for k, name in outputs.items()])


# ---- group counts ------------------------------------------------------------------------------


def shares(
    df: DataFrame, by: str, count: str = "cantidad", share: str = "porcentaje", weight: str | None = None
) -> DataFrame:
    """Rows per value with percent of all rows, most frequent first; ``weight`` says how many rows a row stands for.

    The total is a scalar over the grouped counts, so no window gathers the groups in one task.
    """
    rows = F.sum(col(weight)) if weight else F.count(F.lit(1))
    counts = df.groupBy(col(by)).agg(rows.alias(count))
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, percent(F.col(count), total)).orderBy(F.desc(count), col(by).asc_nulls_last())


def value_counts(df: DataFrame, by: str, count: str = "cantidad") -> DataFrame:
    return df.groupBy(col(by)).agg(F.count(F.lit(1)).alias(count)).orderBy(col(by).asc_nulls_last())


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).distinct().orderBy(col(column).asc_nulls_last())


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "cantidad") -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


#: Keys, about, that one task of :func:`any_repeated` holds.
KEYS_PER_TASK = 500_000


def any_repeated(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key is in several rows; keys with a null do not count.

    Where nearly all keys differ, combining them ahead of the shuffle only fills memory with what a task reads. Here
    keys go to as many tasks as their number takes, so no task holds more of them as the table grows.
    """
    tasks = max(math.ceil(df.count() / KEYS_PER_TASK), 1)
    known = df.select(*[col(k) for k in keys])
    for k in keys:
        known = known.filter(col(k).isNotNull())
    dealt = known.repartition(tasks, *[col(k) for k in keys])
    return not duplicate_keys(dealt, keys).isEmpty()


# ---- column profiles: one aggregate for all columns, then one row per column -------------------------


def _rows_from(
    df: DataFrame,
    measures: Mapping[str, Mapping[str, Column]],
    label: str,
    total: str | None = None,
    rows: Column | None = None,
) -> DataFrame:
    """Aggregates every measure of every entry in one pass and returns one row per entry; ``rows`` is the total."""
    aggregates = [m.alias(f"_{i}_{j}") for i, e in enumerate(measures.values()) for j, m in enumerate(e.values())]
    aggregates += [(F.count(F.lit(1)) if rows is None else rows).alias("_total")]
    entries = [
        F.struct(
            F.lit(name).alias(label),
            *[F.col(f"_{i}_{j}").alias(field) for j, field in enumerate(entry)],
            *([F.col("_total").alias(total)] if total else []),
        )
        for i, (name, entry) in enumerate(measures.items())
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column and their share."""
    names = columns or df.columns
    counted = _rows_from(df, {n: {"nulos": F.count_if(col(n).isNull())} for n in names}, "columna", "total")
    return counted.withColumn("porcentaje", percent(F.col("nulos"), F.col("total")))


def range_profile(
    df: DataFrame, minimums: Mapping[str, float], maximums: Mapping[str, float] | None = None
) -> DataFrame:
    """Smallest and largest value per column, and how many values lie outside the bounds."""
    maximums = maximums or {}
    measures = {}
    for name in dict.fromkeys([*minimums, *maximums]):
        low, high = minimums.get(name), maximums.get(name)
        measures[name] = {
            "minimo": F.min(col(name)).cast("double"),
            "maximo": F.max(col(name)).cast("double"),
            "bajo_minimo": F.count_if(col(name) < F.lit(low)) if low is not None else F.lit(0).cast("bigint"),
            "sobre_maximo": F.count_if(col(name) > F.lit(high)) if high is not None else F.lit(0).cast("bigint"),
        }
    return _rows_from(df, measures, "columna")


def condition_profile(
    df: DataFrame, conditions: Mapping[str, Column], label: str = "indicador", weight: str | None = None
) -> DataFrame:
    """How many rows meet each condition, and their share of all rows; ``weight`` says how many rows a row stands for."""

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, col(weight))), F.lit(0).cast("bigint")) if weight else F.count_if(condition)

    counted = _rows_from(df, {n: {"cantidad": rows(c)} for n, c in conditions.items()}, label, "total", rows(F.lit(True)))
    return counted.withColumn("porcentaje", percent(F.col("cantidad"), F.col("total")))


def flag_profile(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return condition_profile(df, {f: col(f) for f in flags})


def invalid_values(df: DataFrame, allowed: Mapping[str, Sequence[str]], sample: int = 5) -> DataFrame:
    """Per column, how many values are not allowed and the first few distinct ones in order.

    Bad values are unpivoted and counted per distinct value; only the first ``sample`` of a column are
    gathered, the rest is summed.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("columna"), F.when(~col(n).isin(*ok), col(n).cast("string")).alias("valor"))
            for n, ok in allowed.items()
        ]
    )
    counts = (
        df.select(F.inline(pairs))
        .filter(F.col("valor").isNotNull())
        .groupBy("columna", "valor")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("columna").agg(F.sum("n").alias("cantidad"), F.count(F.lit(1)).alias("distintos"))
    first = Window.partitionBy("columna").orderBy("valor")
    samples = (
        counts.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= sample)
        .groupBy("columna")
        .agg(F.array_join(F.array_sort(F.collect_list("valor")), ", ").alias("ejemplos"))
    )
    return totals.join(samples, "columna")
