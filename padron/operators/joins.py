"""Left joins against lookups that are unique by key, safe for hot keys on the left.

A lookup is broadcast only after its rows and bytes have been checked against bounds. Beyond the bound the
join shuffles, and rows of hot keys are spread over salts, with only the lookup rows of those keys
repeated. Every left row is kept, whatever the path.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.session import col, has_shared_folder, shared_folder

BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_SHARE = 0.001
SALTS = 256
SALT_COLUMNS = 8


def bounded_copy(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """The table evaluated once, when it is within both bounds, otherwise None.

    Nothing that is larger than the bounds meets in one task, however wide its rows are.
    """
    if max_rows <= 0:
        return None
    once = evaluated_once(df)
    return once.rows if once.within(max_rows, max_bytes) else None


@dataclass(frozen=True)
class Evaluated:
    """A table that has been worked out, with the number of its rows and their size."""

    rows: DataFrame
    count: int
    size: int

    def within(self, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
        return self.count <= max_rows and self.size <= max_bytes


def evaluated_once(df: DataFrame) -> Evaluated:
    """The table stored in the shared folder; its rows and bytes are taken up by the write itself.

    Without a shared folder the rows stay a plan, and counting them is a pass of its own.
    """
    spark, measures = df.sparkSession, [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("size")]
    if not has_shared_folder(spark):
        return Evaluated(df, *df.agg(*measures).first())
    path, seen = shared_folder(spark, "lookup"), Observation(f"lookup-{uuid.uuid4().hex}")
    df.observe(seen, *measures).write.parquet(path)
    return Evaluated(spark.read.schema(df.schema).parquet(path), seen.get["n"], seen.get["size"])


def _row_bytes(schema: T.StructType) -> Column:
    """Approximate width of a row: text by its length, lists by their items, anything else as 16 bytes."""
    width = F.lit(16)
    for f in schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            text = F.octet_length(F.array_join(c.cast("array<string>"), ""))
            width = width + F.coalesce(text + F.size(c) * 8, F.lit(0))
        else:
            width = width + 16
    return width.cast("bigint")


def hot_key_hashes(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of every key that may hold more than ``share`` of the rows; at most ``1 / share`` of them.

    The frequent-items summary never misses such a key. It may add colder ones, which only costs a few
    repeated lookup rows.
    """
    hashed = df.filter(_all_known(keys)).select(_key_hash(keys).alias("_h"))
    return list(hashed.stat.freqItems(["_h"], share).first()[0] or [])


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    *,
    max_rows: int = BROADCAST_ROWS,
    check_size: bool = True,
    spread_hot_keys: bool = True,
) -> DataFrame:
    """Left join to a lookup with at most one row per key; output = left columns + lookup values.

    ``check_size=False`` skips the broadcast attempt for lookups known to grow with the data.
    ``spread_hot_keys=False`` skips the hot-key pass when the left side is already unique by key.
    """
    on = list(on)
    values = [c for c in lookup.columns if c not in on]
    output = [col(c) for c in [*left.columns, *values]]
    lookup = lookup.filter(_all_known(on))

    if check_size and max_rows > 0:
        once = evaluated_once(lookup)
        lookup = once.rows
        if once.within(max_rows):
            return left.join(F.broadcast(lookup), on, "left").select(*output)
    if not spread_hot_keys:
        return left.join(lookup, on, "left").select(*output)

    hashes = hot_key_hashes(left, on)
    is_hot = _key_hash(on).isin(*hashes) if hashes else F.lit(False)
    # The first few plain columns tell rows of one key apart well enough, and any type may be among the others.
    plain = [f.name for f in left.schema.fields if isinstance(f.dataType, T.AtomicType)][:SALT_COLUMNS]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[col(c) for c in plain]), F.lit(SALTS))
    # Rows with an unknown key match nothing; they are spread too, so that they do not meet in one task.
    salted = left.withColumn("_salt", F.when(is_hot | ~_all_known(on), spread).otherwise(F.lit(0).cast("bigint")))
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    only_zero = F.array(F.lit(0).cast("bigint"))
    repeated = lookup.withColumn("_salt", F.explode(F.when(is_hot, every_salt).otherwise(only_zero)))
    return salted.join(repeated, [*on, "_salt"], "left").select(*output)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[col(k) for k in keys])


def _all_known(keys: Sequence[str]) -> Column:
    known = col(keys[0]).isNotNull()
    for k in keys[1:]:
        known = known & col(k).isNotNull()
    return known
