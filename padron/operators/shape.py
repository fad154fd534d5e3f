"""Projection, renaming, ordering and casts driven by a table specification."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.functions import cells
from padron.session import col
from padron.sources.specs import FieldSpec, TableSpec


def missing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n not in df.columns]


def select_known(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    """Specified columns in the table's own order, and the ones the table lacks."""
    wanted = set(spec.columns)
    return df.select(*[col(c) for c in df.columns if c in wanted]), missing_columns(df, spec.columns)


def select_in_spec_order(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    """Specified columns in the specification's order, and the ones the table lacks."""
    return df.select(*[col(c) for c in spec.columns if c in df.columns]), missing_columns(df, spec.columns)


def select_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[col(n) for n in names])


def rename_any(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Renames whichever source names are present; several sources may share one target."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    if len(set(present.values())) < len(present):
        raise ValueError(f"two columns of one table map to the same name: {present}")
    return df.withColumnsRenamed(present)


def move_to_front(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[col(n) for n in names], *[col(c) for c in df.columns if c not in names])


def insert_after(df: DataFrame, name: str, anchor: str) -> DataFrame:
    rest = [c for c in df.columns if c != name]
    at = rest.index(anchor) + 1
    return df.select(*[col(c) for c in [*rest[:at], name, *rest[at:]]])


def with_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def all_to_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[col(c) if c in keep else col(c).cast("string").alias(c) for c in df.columns])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def map_text_columns(df: DataFrame, change: Callable[[Column], Column], keep: Sequence[str] = ()) -> DataFrame:
    """Applies one cell rule to every text column in a single projection."""
    texts = set(text_columns(df)) - set(keep)
    return df.select(*[change(col(c)).alias(c) if c in texts else col(c) for c in df.columns])


def trim_text(df: DataFrame) -> DataFrame:
    return map_text_columns(df, cells.strip)


def fill_text(df: DataFrame, value: str = "") -> DataFrame:
    return map_text_columns(df, lambda c: F.coalesce(c, F.lit(value)))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all columns in first-seen order; a column that a table lacks is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


# ---- casts -------------------------------------------------------------------------------------


def typed(
    df: DataFrame,
    field: FieldSpec,
    parse_date: Callable[[Column], Column] = cells.datetime_text_to_date,
    int_from_decimal_text: bool = False,
) -> Column:
    """The column under its declared type; a value that does not fit becomes null."""
    c, target = col(field.name), field.spark_type
    source = df.schema[field.name].dataType
    if source == target:
        return c
    if not isinstance(source, T.StringType):
        return c.try_cast(target)
    if isinstance(target, T.DateType):
        return parse_date(c)
    if isinstance(target, T.LongType):
        shape = r"^[+-]?[0-9]+(\.0*)?$" if int_from_decimal_text else cells.INTEGER_SHAPE
        digits = F.regexp_replace(c, r"\.0*$", "") if int_from_decimal_text else c
        return F.when(c.rlike(shape), digits.try_cast(target))
    if isinstance(target, T.DoubleType):
        return F.when(c.rlike(cells.NUMBER_SHAPE), c.try_cast(target))
    if isinstance(target, T.BooleanType):
        return F.when(c == "true", F.lit(True)).when(c == "false", F.lit(False))
    return c.try_cast(target)


def tolerant_cast(df: DataFrame, spec: TableSpec, **options: Any) -> DataFrame:
    """Declared types, bad values to null. Columns outside the specification pass through."""
    declared = {f.name: f for f in spec.fields}
    return df.select(
        *[typed(df, declared[c], **options).alias(c) if c in declared else col(c) for c in df.columns]
    )


def strict_or_text_cast(df: DataFrame, spec: TableSpec, **options: Any) -> tuple[DataFrame, list[str]]:
    """Declared types column by column: one bad value keeps the whole column as text. Dates stay tolerant.

    All candidate columns are judged in one aggregate; its single row is all that reaches the driver.
    Returns the table and the names left as text.
    """
    declared = {f.name: f for f in spec.fields if f.name in df.columns}
    judged = [
        n
        for n, f in declared.items()
        if isinstance(df.schema[n].dataType, T.StringType) and f.type in ("integer", "float", "boolean")
    ]
    bad: list[str] = []
    if judged:
        tests = [
            F.count_if(col(n).isNotNull() & typed(df, declared[n], **options).isNull()).alias(f"_{i}")
            for i, n in enumerate(judged)
        ]
        counts = df.agg(*tests).first()
        bad = [n for i, n in enumerate(judged) if counts[i] > 0]
    kept = {n: f for n, f in declared.items() if n not in bad}
    return tolerant_cast(df, TableSpec(spec.name, tuple(kept.values())), **options), bad
