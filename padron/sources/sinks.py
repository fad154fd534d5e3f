"""Parquet outputs with a stable and a dated copy, review extracts, and output checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.session import col
from padron.sources import tables

CODEC = "snappy"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class OrderError(RuntimeError):
    """A table that should be stored in order is not."""


def run_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H-%M-%S")


def write_current(
    df: DataFrame,
    path: str,
    compression: str = CODEC,
    partition_by: Sequence[str] = (),
    order: Sequence[Column] = (),
    observe: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replaces one Parquet table and returns it as stored; until the new one is complete, the old one stays.

    A partitioned table is rebalanced by its partition columns first: few files per partition, and a
    partition that holds much of the data is split over several tasks. With an ``order`` the files follow it, which
    is checked before the table counts. The number of rows (``filas``) and what ``observe`` names are taken up while
    the rows are written and stay with the table (:func:`padron.sources.tables.metrics`).
    """
    return stage(df, path, compression, partition_by, order, observe).publish()


@dataclass(frozen=True)
class Staged:
    """A complete table beside its place, with what was observed while it was written."""

    spark: SparkSession
    folder: str
    path: str
    schema: T.StructType
    metrics: Mapping[str, Any]

    def read(self, folder: str | None = None) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(folder or self.folder)

    def publish(self) -> DataFrame:
        """Makes the table the current one at its path, and returns it from there."""
        tables.publish(self.spark, self.folder, self.path, self.schema, self.metrics)
        return self.read(self.path)

    def discard(self) -> None:
        discard(self.spark, self.folder)


def stage(
    df: DataFrame,
    path: str,
    compression: str = CODEC,
    partition_by: Sequence[str] = (),
    order: Sequence[Column] = (),
    observe: Mapping[str, Column] | None = None,
    writers: int = 0,
) -> Staged:
    """Writes a table beside ``path`` without making it current.

    A task sorts its rows by the partition columns, unless it has no more partitions than ``writers``.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    elif partition_by:
        df = df.hint("rebalance", *[col(c) for c in partition_by])
    spark, beside = df.sparkSession, tables.beside_path(path)
    # Taken up in the stage that writes, where each partition counts once however often it is tried.
    seen = Observation(f"write-{uuid.uuid4().hex}")
    measures = {"filas": F.count(F.lit(1)), **(observe or {})}
    watched = df.observe(seen, *[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    with _open_together(spark, writers):
        watched.write.option("compression", compression).partitionBy(*partition_by).parquet(beside)
    metrics = {name: seen.get[f"m{i}"] for i, name in enumerate(measures)}
    if order:
        check_order(spark, beside, order)
    return Staged(spark, beside, path, _stored_schema(df, partition_by), metrics)


@contextmanager
def _open_together(spark: SparkSession, writers: int) -> Iterator[None]:
    """Lets a task keep so many files open at a time, in which case it need not sort its rows by partition."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, writers or before)
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Makes a complete table the current one at ``path``."""
    tables.publish(spark, written, path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table that was written beside its place and is not needed."""
    tables.Files(spark, path).delete(path)


def check_order(spark: SparkSession, folder: str, order: Sequence[Column]) -> None:
    """Raises unless each file's last row is at most the next file's first row; compares two rows a file."""
    stored = spark.read.parquet(folder)
    own, at = F.struct(*[col(c) for c in stored.columns]), F.col("_metadata.row_index")
    ends = stored.groupBy(F.col("_metadata.file_name").alias("_file")).agg(F.min_by(own, at).alias("_first"), F.max_by(own, at).alias("_last"))
    rows = ends.select("_file", F.posexplode(F.array("_first", "_last")).alias("_end", "_row")).select("_file", "_end", "_row.*")
    place = ["_file", "_end"]
    ranked = rows.select(
        F.row_number().over(Window.orderBy(*place)).alias("_by_file"),
        F.row_number().over(Window.orderBy(*order, *place)).alias("_by_key"),
    )
    if not ranked.filter("_by_file <> _by_key").isEmpty():
        raise OrderError(f"files of {folder} are not in order")


def write_reports(reports: Mapping[str, DataFrame], base: str, flow: str) -> dict[str, str]:
    """Each report as a table under ``reportes/<flow>``; returns the paths by name."""
    paths = {name: f"{base}/reportes/{flow}/{name}" for name in reports}
    for name, df in reports.items():
        write_current(df, paths[name])
    return paths


def _stored_schema(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """The written columns with partition columns last and under their own type, not an inferred one."""
    inner = [f for f in df.schema.fields if f.name not in partition_by]
    return T.StructType([*inner, *[df.schema[c] for c in partition_by]])


def write_versioned(
    df: DataFrame,
    base: str,
    name: str,
    run_ts: str | None = None,
    compression: str = CODEC,
    partition_by: Sequence[str] = (),
    order: Sequence[Column] = (),
    observe: Mapping[str, Column] | None = None,
) -> dict[str, str]:
    """``historico/<name>/run_ts=…`` for this run, and the same rows under ``actual/<name>``.

    The plan runs once: the dated copy is written first and the stable copy is made from it, so both agree, also in
    their ``order``. The stable name's manifest points to the dated copy as soon as that is complete; the stable copy
    for plain readers is then written beside the previous one and takes its place.
    """
    dated, stable = f"{base}/historico/{name}/run_ts={run_ts or run_stamp()}", f"{base}/actual/{name}"
    staged = stage(df, dated, compression, partition_by, order, observe)
    staged.publish()
    _make_current(staged, dated, stable, compression, partition_by, order)
    return {"actual": stable, "historico": dated}


def _make_current(
    staged: Staged, dated: str, stable: str, compression: str, partition_by: Sequence[str] = (), order: Sequence[Column] = ()
) -> None:
    """The dated copy becomes the current rows of the stable name, and is copied there for plain readers."""
    spark = staged.spark
    place = tables.Files(spark, dated).place(dated)
    tables.recover(spark, stable)
    tables.commit(spark, stable, [place], staged.schema, metrics=staged.metrics)
    copy = stage(staged.read(dated), stable, compression, partition_by, order)
    tables.publish(spark, copy.folder, stable, staged.schema, staged.metrics, also=[place])


def write_split(branches: Mapping[str, DataFrame], base: str, run_ts: str | None = None) -> dict[str, dict[str, str]]:
    """Versioned output per branch; an empty branch is not written."""
    stamp = run_ts or run_stamp()
    return {
        name: write_versioned(df, base, name, stamp) for name, df in branches.items() if not df.isEmpty()
    }


BRANCH = "_rama"


def write_branches(
    df: DataFrame, conditions: Mapping[str, Column], base: str, run_ts: str | None = None, compression: str = CODEC
) -> dict[str, dict[str, str]]:
    """Versioned output per branch from one pass over ``df``; a branch without rows is not published.

    A row goes to every branch whose condition it meets, and to none if it meets none. All branches are one write
    with a branch column; each branch's folder then becomes its dated copy. Counts are observed while writing. A task
    keeps a file of each branch open, so it holds no rows.
    """
    if BRANCH in df.columns:
        raise ValueError(f"column '{BRANCH}' is taken")
    stamp, spark = run_ts or run_stamp(), df.sparkSession
    tags = {name: F.coalesce(c, F.lit(False)) for name, c in conditions.items()}
    rows = df.filter(reduce(or_, tags.values())).select(
        *[col(c) for c in df.columns],
        F.explode(F.filter(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(tags.values())]), lambda t: t.isNotNull())).alias(BRANCH),
    )
    counts = {name: F.count_if(F.col(BRANCH) == i) for i, name in enumerate(tags)}
    staged = stage(rows, f"{base}/historico/{BRANCH}", compression, [BRANCH], observe=counts, writers=len(tags))
    files, paths = tables.Files(spark, base), {}
    for i, name in enumerate(tags):
        if not staged.metrics[name]:
            continue
        dated, stable = f"{base}/historico/{name}/run_ts={stamp}", f"{base}/actual/{name}"
        files.make_folder(f"{base}/historico/{name}")
        metrics = {"filas": staged.metrics[name]}
        branch = Staged(spark, f"{staged.folder}/{BRANCH}={i}", dated, df.schema, metrics)
        branch.publish()
        _make_current(branch, dated, stable, compression)
        paths[name] = {"actual": stable, "historico": dated}
    staged.discard()
    return paths


def review_frame(df: DataFrame) -> DataFrame:
    """Dates as text, for people who open the extract in a spreadsheet."""
    dates = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    return df.select(*[F.date_format(col(c), "yyyy-MM-dd").alias(c) if c in dates else col(c) for c in df.columns])


def write_review(df: DataFrame, path: str) -> None:
    review_frame(df).write.mode("overwrite").option("header", True).csv(path)


def flat_outputs(paths: Mapping[str, Any], ahead: str = "") -> dict[str, str]:
    """Every path of a run under a name of its own, whatever is nested where: ``flags.actual``, ``flags.historico``."""
    found: dict[str, str] = {}
    for name, path in paths.items():
        found |= flat_outputs(path, f"{ahead}{name}.") if isinstance(path, Mapping) else {f"{ahead}{name}": path}
    return found


def missing_outputs(spark: SparkSession, required: Mapping[str, str], optional: Mapping[str, str] | None = None) -> list[str]:
    """Names of optional outputs that are absent; an absent required output is an error."""

    def absent(paths: Mapping[str, str]) -> list[str]:
        return [name for name, path in paths.items() if not tables.exists(spark, path)]

    lacking = absent(required)
    if lacking:
        raise FileNotFoundError(f"missing outputs: {lacking}")
    return absent(optional or {})
