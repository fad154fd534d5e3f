"""Payroll and mining payroll: many monthly sheets to one consolidated text table, then typed gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions import calendar, cells
from padron.operators import quality, rows, shape
from padron.plans.tables import MINING_PAYROLL, PAYROLL
from padron.session import col
from padron.sources import grid as grids
from padron.sources import sinks
from padron.sources.contracts import SourceContract
from padron.sources.specs import TableSpec

SHEET = "Planilla"
HEADER = grids.HeaderRule(row=6, stop="gap")
KEY = "DNI/CEX"
CODEC = "zstd"


def consolidate(
    grid: DataFrame, own_outputs: tuple[str, ...] = (), footer_length: int = rows.FOOTER_LENGTH
) -> tuple[DataFrame, DataFrame]:
    """(silver text table, rejected files). Columns are matched by name over all files, values by position."""
    usable = grids.usable_files(grid, own_outputs)
    body, rejected = grids.triage(usable, SHEET, HEADER, lambda name: name == KEY)
    data = body.filter((F.col("row_idx") <= HEADER.row) | rows.is_data_row(F.get("cells", F.lit(0)), footer_length))
    table, names = grids.promote_header(data, HEADER, keep=("PERIODO",))
    names = [n for n in names if n not in ("PERIODO", "AÑO", "MES")]
    if KEY in names:
        table = rows.drop_null_key(table, KEY)
    period = F.col("PERIODO")
    silver = table.select(
        "PERIODO",
        calendar.period_year(period).alias("AÑO"),
        calendar.period_month(period).alias("MES"),
        *[col(n) for n in names],
    )
    return silver, rejected


def _with_month_name(df: DataFrame) -> DataFrame:
    named = df.withColumn("NOMBRE_MES", calendar.month_name(F.col("MES")))
    return shape.insert_after(named, "NOMBRE_MES", "MES")


def gold(
    silver: DataFrame, spec: TableSpec = PAYROLL, strict: bool = True, int_from_decimal_text: bool = False
) -> tuple[DataFrame, dict[str, list[str]]]:
    """(typed table, notes). ``strict`` keeps a column as text when any value does not fit its type."""
    chosen, missing = shape.select_in_spec_order(silver, spec)
    options = {
        "parse_date": cells.fractional_datetime_text_to_date,
        "int_from_decimal_text": int_from_decimal_text,
    }
    if strict:
        cast, as_text = shape.strict_or_text_cast(chosen, spec, **options)
    else:
        cast, as_text = shape.tolerant_cast(chosen, spec, **options), []
    return _with_month_name(shape.trim_text(cast)), {"missing": missing, "kept_as_text": as_text}


def mining_gold(silver: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
    return gold(silver, MINING_PAYROLL, strict=False)


def findings(gold_table: DataFrame, extras: bool = False) -> DataFrame:
    """Constraint report of payroll gold; it informs and never blocks."""
    return quality.constraint_findings(gold_table, PAYROLL, extras=extras)


def run(
    grid: DataFrame,
    base: str,
    mining: bool = False,
    own_outputs: tuple[str, ...] = (),
    contract: SourceContract | None = None,
    unreadable: DataFrame | None = None,
) -> dict[str, str]:
    """Checked sources, silver with its rejected files, gold with its constraint report and casting notes.

    ``unreadable`` are files that :func:`padron.sources.grid.read_grid_files` could not open; they are reported with
    the rejected ones.
    """
    quality.preflight(grids.usable_files(grid, own_outputs), contract)
    name = "nomina_regimen_minero" if mining else "nomina"
    silver, rejected = consolidate(grid, own_outputs)
    stored = sinks.write_current(silver, f"{base}/silver/{name}_silver", CODEC, ["PERIODO"])
    typed, notes = mining_gold(stored) if mining else gold(stored)
    done = sinks.write_current(typed, f"{base}/gold/actual/{name}_gold", partition_by=["PERIODO"])
    spec = MINING_PAYROLL if mining else PAYROLL
    noted = [(kind, column) for kind, columns in notes.items() for column in columns]
    reports = {
        "rechazados": rejected if unreadable is None else rejected.unionByName(unreadable),
        "hallazgos": quality.constraint_findings(done, spec),
        "notas": grid.sparkSession.createDataFrame(noted, "nota string, columna string"),
    }
    paths = {"silver": f"{base}/silver/{name}_silver", "gold": f"{base}/gold/actual/{name}_gold"}
    paths |= sinks.write_reports(reports, base, name)
    sinks.missing_outputs(grid.sparkSession, paths)
    return paths
