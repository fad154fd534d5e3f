"""Income relation: the employee and intern sheets to clean text, then typed gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from padron.functions import calendar, cells
from padron.operators import quality, rows, shape
from padron.operators.aggregates import distinct_values, null_profile, value_counts
from padron.plans.tables import INCOME_EMPLOYEES, INCOME_INTERNS
from padron.session import col
from padron.sources import grid as grids
from padron.sources import sinks, tables
from padron.sources.contracts import SourceContract

HEADERS = {
    "EMPLEADOS": grids.HeaderRule(row=2, start_col=2),
    "PRACTICANTES": grids.HeaderRule(row=2, start_col=1),
}
UNIVERSITY = "Universidad de Procedencia"


def read_sheet(grid: DataFrame, sheet: str) -> DataFrame:
    """The sheet as text, up to its first blank row."""
    table, names = grids.promote_header(grids.pick_sheet(grid, sheet), HEADERS[sheet], require_header=True)
    kept = rows.stop_at_first(table, grids.row_is_blank())
    return kept.select(*[col(n) for n in names])


def clean(sheet_table: DataFrame) -> DataFrame:
    changes = {}
    if "PROYECTO" in sheet_table.columns:
        changes["PROYECTO"] = cells.staff_default(col("PROYECTO"))
    if "CODIGO SAP" in sheet_table.columns:
        changes["CODIGO SAP"] = cells.sentinel_to_null(col("CODIGO SAP"))
    tidy = rows.drop_empty_rows(sheet_table.withColumns(changes) if changes else sheet_table)
    if not {"AÑO", "MES"} <= set(tidy.columns):
        return tidy
    return shape.move_to_front(tidy.withColumn("PERIODO", calendar.build_period(col("AÑO"), col("MES"))), "PERIODO")


def _with_month_name(df: DataFrame) -> DataFrame:
    named = df.withColumn("NOMBRE_MES", calendar.month_name(F.col("MES"), default=""))
    return shape.insert_after(named, "NOMBRE_MES", "MES")


def employees_gold(silver: DataFrame) -> DataFrame:
    typed = shape.tolerant_cast(shape.select_required(silver, INCOME_EMPLOYEES.columns), INCOME_EMPLOYEES)
    filled = typed.withColumns({c: cells.empty_default(col(c)) for c in ("SERVICIO", "REGIMEN")})
    return _with_month_name(filled)


def interns_gold(silver: DataFrame) -> DataFrame:
    typed = shape.tolerant_cast(shape.select_required(silver, INCOME_INTERNS.columns), INCOME_INTERNS)
    return _with_month_name(typed.withColumn(UNIVERSITY, cells.null_default(col(UNIVERSITY))))


def reports(before: DataFrame, after: DataFrame, gold: DataFrame) -> dict[str, DataFrame]:
    """Cleaning report of a sheet, periods, nulls, and interns per university where the column exists."""
    return {"etapa": quality.stage_report(before, after), "nulos": null_profile(gold), **groups(gold)}


def groups(gold: DataFrame) -> dict[str, DataFrame]:
    """Reports that group the rows: periods, and interns per university where the column exists."""
    out = {"periodos": distinct_values(gold, "PERIODO")}
    if UNIVERSITY in gold.columns:
        out["universidades"] = value_counts(gold, UNIVERSITY)
    return out


def run(grid: DataFrame, base: str, contract: SourceContract | None = None) -> dict[str, object]:
    """Checked sources; per sheet silver, gold, and the reports on both."""
    quality.preflight(grid, contract)
    paths: dict[str, object] = {}
    stamp = sinks.run_stamp()
    spark = grid.sparkSession
    for sheet, to_gold in (("EMPLEADOS", employees_gold), ("PRACTICANTES", interns_gold)):
        path, flow = f"{base}/silver/relacion_ingresos_{sheet.lower()}", f"ingresos_{sheet.lower()}"
        # Rows ahead of the cleaning are counted by the write that follows, not by a pass of their own.
        read = Observation(f"read-{flow}-{stamp}")
        cleaned = clean(read_sheet(grid, sheet).observe(read, F.count(F.lit(1)).alias("filas")))
        silver = sinks.write_current(cleaned, path, observe=quality.null_measures(cleaned.columns))
        paths[f"silver_{sheet.lower()}"] = path
        name = f"relacion_ingresos_{sheet.lower()}_gold"
        typed = to_gold(silver)
        paths[name] = sinks.write_versioned(typed, f"{base}/gold", name, stamp, observe=quality.null_measures(typed.columns))
        gold = tables.read(spark, paths[name]["actual"])
        told = {
            "etapa": quality.observed_stage(spark, read.get["filas"], tables.metrics(spark, path)),
            "nulos": quality.observed_nulls(spark, tables.metrics(spark, paths[name]["actual"])),
            **groups(gold),
        }
        paths[f"reportes_{sheet.lower()}"] = sinks.write_reports(told, base, flow)
    sinks.missing_outputs(spark, sinks.flat_outputs(paths))
    return paths
