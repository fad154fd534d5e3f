"""Raw sheet grids to tables.

A grid is ``file STRING, sheet STRING, row_idx INT|BIGINT (1-based), cells ARRAY<STRING>``. Headers become
a lookup with one row per sheet that holds, for each output column, the position of its cell; data rows
then pick cells by position, so files with drifting headers share one projection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions import cells
from padron.functions.calendar import period_from_name
from padron.operators.joins import BROADCAST_BYTES, bounded_copy, lookup_join

GRID_COLUMNS = ("file", "sheet", "row_idx")
GRID_SCHEMA = "file string, sheet string, row_idx bigint, cells array<string>"
# Files that could not be used, with the reason.
REJECTED = "file string, motivo string"
UNREADABLE = "ilegible"
# More columns than any sheet can have; a header set beyond it means the header row is wrong.
MAX_COLUMNS = 16_384
# Absent headers an error message names; it gives their number as well.
SHOWN_HEADERS = 50
# Width of one cell position in a header lookup.
POSITION_BYTES = 8
# Fixed value: blanks a payroll header may contain.
HEADER_GAP = 3
# Fixed value: prefix of lock files left by open workbooks.
LOCK_PREFIX = "~$"


class SheetError(ValueError):
    """A sheet or header that a job cannot do without is missing."""


@dataclass(frozen=True)
class HeaderRule:
    """Where the header is and how it is read.

    ``stop``: 'first_blank' ends at the first blank cell, 'skip_blank' passes over blanks, 'gap' passes over
    up to three blanks in all. ``one_line`` collapses line breaks and runs of spaces in names.
    """

    row: int
    start_col: int = 1
    stop: str = "first_blank"
    one_line: bool = False


# ---- reading -----------------------------------------------------------------------------------


def read_grid(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return reader.parquet(path)


def read_grid_files(spark: SparkSession, path: str, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of all readable files, the others with the reason): one broken file does not stop the rest.

    A file counts as readable if its footer can be read, which a count without columns finds out; the others are
    left out of the scan by name. Damage inside a readable file still stops the job, so no file is read in part.
    """
    reader = spark.read.schema(GRID_SCHEMA)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.parquet(path)
    name = F.col("_metadata.file_path")
    opened = reader.option("ignoreCorruptFiles", "true").parquet(path).groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    # Local files are listed with three slashes and read with one.
    listed = spark.createDataFrame([(re.sub("^file:/+", "file:/", f),) for f in found.inputFiles()], "file string")
    broken = listed.join(opened, "file", "left_anti").withColumn("motivo", F.lit(UNREADABLE))
    # No more names than the driver's own file index holds.
    names = [r["file"] for r in broken.collect()]
    reader = reader.option("ignoreCorruptFiles", "false")
    good = reader.parquet(path)
    return good.filter(~name.isin(*names)) if names else good, spark.createDataFrame([(n, UNREADABLE) for n in names], REJECTED)


def usable_files(grid: DataFrame, own_outputs: Sequence[str] = ()) -> DataFrame:
    """Without lock files and the job's own earlier outputs, both known by prefix."""
    for prefix in (LOCK_PREFIX, *own_outputs):
        grid = grid.filter(~base_name(F.col("file")).startswith(prefix))
    return grid


def base_name(file: Column) -> Column:
    """The last part of a path written with either kind of slash."""
    return F.substring_index(F.regexp_replace(file, r"\\", "/"), "/", -1)


def pick_sheet(grid: DataFrame, sheet: str, required: bool = True) -> DataFrame:
    """Rows of one sheet; when required, its absence from the whole input is an error."""
    rows = grid.filter(F.col("sheet") == sheet)
    if required and rows.isEmpty():
        raise SheetError(f"sheet '{sheet}' does not exist")
    return rows


def with_period(grid: DataFrame, sheet: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the sheet with PERIODO from the file name, rejected files with the reason).

    Files without a period or without the sheet are rejected and reported; no good file at all is an error.
    """
    periods = period_from_name(base_name(F.col("file")))
    known = grid.withColumn("PERIODO", periods)
    rows = known.filter((F.col("sheet") == sheet) & F.col("PERIODO").isNotNull())
    files = (
        grid.groupBy("file")
        .agg(F.max(F.col("sheet") == sheet).alias("has_sheet"))
        .withColumn(
            "motivo",
            F.when(periods.isNull(), F.lit("sin periodo")).when(~F.col("has_sheet"), F.lit("sin hoja " + sheet)),
        )
    )
    if rows.isEmpty():
        raise SheetError("no file could be processed")
    return rows, files.filter(F.col("motivo").isNotNull()).select("file", "motivo")


def triage(
    grid: DataFrame, sheet: str, rule: HeaderRule, key: Callable[[Column], Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows of the sheet in the files that can be used, with PERIODO; rejected files with the first reason).

    A file is rejected without a period in its name, without the sheet, without a header in the header row, or, if
    other files have a header that passes ``key``, without such a one. The reasons come from narrow columns and the
    header rows, one line a file; the rows of the other files are not read for it. No good file is an error.
    """
    periods = period_from_name(base_name(F.col("file")))
    named = F.col("names")
    heads = header_layout(grid.filter(F.col("sheet") == sheet), rule).groupBy("file").agg(
        F.max(F.exists(named, lambda n: n.isNotNull())).alias("has_header"),
        F.max(F.exists(named, lambda n: F.coalesce(key(n), F.lit(False))) if key else F.lit(True)).alias("has_key"),
    )
    files = grid.groupBy("file").agg(F.max(F.col("sheet") == sheet).alias("has_sheet")).join(heads, "file", "left")
    reason = (
        F.when(periods.isNull(), F.lit("sin periodo")).when(~F.col("has_sheet"), F.lit("sin hoja " + sheet))
        .when(~F.coalesce("has_header", F.lit(False)), F.lit("sin cabecera"))
        .when(~F.col("has_key"), F.lit("sin columna clave"))
    )
    judged = files.select("file", reason.alias("motivo"))
    if key is not None and judged.filter("motivo IS NULL").isEmpty():
        judged = judged.withColumn("motivo", F.when(F.col("motivo") != "sin columna clave", F.col("motivo")))
    rejected = judged.filter("motivo IS NOT NULL")
    small = bounded_copy(rejected)
    rejected = rejected if small is None else small
    rows = lookup_join(grid.filter(F.col("sheet") == sheet), rejected, ["file"]).filter("motivo IS NULL").drop("motivo")
    rows = rows.withColumn("PERIODO", periods)
    if rows.isEmpty():
        raise SheetError("no file could be processed")
    return rows, rejected.select("file", "motivo")


# ---- headers -----------------------------------------------------------------------------------


def header_layout(grid: DataFrame, rule: HeaderRule) -> DataFrame:
    """(file, sheet, names): names by cell position, null where a cell is not a header."""
    clean = cells.one_line if rule.one_line else cells.strip
    scanned = F.transform("cells", lambda c, i: F.when((i >= rule.start_col - 1) & cells.has_text(c), clean(c)))
    named = grid.filter(F.col("row_idx") == rule.row).select("file", "sheet", scanned.alias("names"))
    if rule.stop == "skip_blank":
        return named
    if rule.stop == "first_blank":
        tail = F.slice("names", F.lit(rule.start_col), F.size("names"))
        blank_at = F.array_position(F.transform(tail, lambda n: n.isNull()), True)
        last = F.when(blank_at > 0, blank_at - 1 + rule.start_col - 1).otherwise(F.size("names"))
    elif rule.stop == "gap":
        blanks = F.filter(F.sequence(F.lit(0), F.size("names") - 1), lambda i: F.get("names", i).isNull())
        beyond = F.get(blanks, F.lit(HEADER_GAP))
        last = F.coalesce(beyond, F.size("names"))
    else:
        raise ValueError(f"unknown header rule: {rule.stop}")
    return named.withColumn("names", F.slice("names", F.lit(1), last.cast("int")))


def column_names(layout: DataFrame) -> list[str]:
    """Every header name, in the order of first appearance over files and positions."""
    seen = (
        layout.select("file", "sheet", F.posexplode("names").alias("at", "name"))
        .filter(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.min(F.struct("file", "sheet", "at")).alias("first"))
    )
    names = [r["name"] for r in seen.orderBy("first").limit(MAX_COLUMNS + 1).collect()]
    if len(names) > MAX_COLUMNS:
        raise SheetError(f"more than {MAX_COLUMNS} different headers")
    if not names:
        raise SheetError("no header found")
    return names


def missing_headers(layout: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(file, sheet, column) for every target a sheet lacks."""
    wanted = F.array(*[F.lit(t) for t in targets])
    return layout.select("file", "sheet", F.explode(F.array_except(wanted, F.col("names"))).alias("column"))


def promote_header(
    grid: DataFrame,
    rule: HeaderRule,
    targets: Sequence[str] | None = None,
    keep: Sequence[str] = GRID_COLUMNS,
    key: Callable[[Column], Column] | None = None,
    require_header: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Data rows below the header as named text columns, and the names.

    Without ``targets`` the columns are all headers found, a file without one giving null. With ``targets``
    only those are read and every sheet must have them. When a name repeats, its last column counts.
    ``width`` is the end of the sheet's header, for rules that look at whole rows. ``key`` is a test of header
    names: the cell below each sheet's first column that passes it becomes ``_key``, wherever that column is and
    whatever it is called there; every sheet must have one. A sheet without a header gives no
    rows; with ``require_header`` one that has rows is an error that names it.
    """
    layout = header_layout(grid, rule)
    if require_header:
        last = grid.groupBy("file", "sheet").agg(F.max("row_idx").alias("_last"))
        layout = last.join(layout, ["file", "sheet"], "left")
    small = bounded_copy(layout)
    layout = layout if small is None else small
    if require_header:
        named = F.exists("names", lambda n: n.isNotNull())
        headless = layout.filter((F.col("_last") > rule.row) & ~F.coalesce(named, F.lit(False)))
        _raise_for(headless.select("file", "sheet", F.lit(f"row {rule.row}").alias("column")), "no header")
        layout = layout.filter("names IS NOT NULL").drop("_last")
        small = None if small is None else layout
    if targets is not None:
        _raise_for(missing_headers(layout, targets), "missing headers")
    if key is not None:
        keyless = layout.filter(~F.exists("names", lambda n: F.coalesce(key(n), F.lit(False))))
        _raise_for(keyless.select("file", "sheet", F.lit("no key column").alias("column")), "no key column")
    names = list(targets) if targets is not None else column_names(layout)

    def position(name: str) -> Column:
        from_end = F.array_position(F.reverse("names"), name).cast("int")
        return F.when(from_end > 0, F.size("names") - from_end + 1)

    at_key = F.lit(None).cast("int")
    if key is not None:
        at_key = F.array_position(F.transform("names", lambda n: F.coalesce(key(n), F.lit(False))), True).cast("int")
    places = layout.select(
        "file",
        "sheet",
        F.array(*[position(n) for n in names]).alias("_at"),
        F.size("names").alias("_width"),
        at_key.alias("_key_at"),
    )
    body = grid.filter(F.col("row_idx") > rule.row)
    if small is not None and small.count() * len(names) * POSITION_BYTES <= BROADCAST_BYTES:
        placed = body.join(F.broadcast(places), ["file", "sheet"])
    else:
        placed = lookup_join(body, places, ["file", "sheet"]).filter(F.col("_at").isNotNull())
    # Unlike an index, element access is not copied into every later use of the column.
    picked = [F.try_element_at("cells", F.get("_at", F.lit(i))).alias(n) for i, n in enumerate(names)]
    row_cells = F.slice("cells", F.lit(rule.start_col), F.greatest(F.col("_width") - rule.start_col + 1, F.lit(0)))
    own_key = [] if key is None else [F.try_element_at("cells", F.col("_key_at")).alias("_key")]
    table = placed.select(*keep, *picked, row_cells.alias("_row"), *own_key)
    return table, names


def _raise_for(absent: DataFrame, title: str) -> None:
    """An error that names the first absent headers and says how many there are in all."""
    shown = absent.orderBy("file", "sheet", "column").limit(SHOWN_HEADERS).collect()
    if shown:
        listed = "; ".join(f"{r.file}/{r.sheet}: {r.column}" for r in shown)
        raise SheetError(f"{title} ({absent.count()} in total): {listed}")


def row_is_blank() -> Column:
    """True when no cell under the sheet's header holds text."""
    return F.forall("_row", cells.is_blank)
