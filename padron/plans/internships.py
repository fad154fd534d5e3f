"""Internship control: one sheet to a clean table, then tenure, flags and phrase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions import calendar, cells
from padron.operators import quality, rows
from padron.operators.aggregates import condition_profile
from padron.plans.tables import INTERNSHIPS
from padron.session import col
from padron.sources import grid as grids
from padron.sources import sinks
from padron.sources.contracts import SourceContract

SHEET = "Practicantes"
HEADER = grids.HeaderRule(row=4, stop="skip_blank", one_line=True)
BLANK_RUN = 1000
DATES = ("FECHA ING", "F. RENOVACION")
FLAGS = ("por_cumplir_1", "cumplio_1", "por_cumplir_2")
# The columns of the gold table that come from the sheet, with their output names.
CARRIED = {
    "DNI": "DNI",
    "CONDICION": "CONDICION",
    "FECHA ING": "Fecha_Ingreso",
    "F. RENOVACION": "Fecha_Renovacion",
    "SEDE": "SEDE",
    "UNIVERSIDAD": "UNIVERSIDAD",
    "JEFE INMEDIATO": "JEFE INMEDIATO",
    "GERENCIA": "GERENCIA",
}


def clean(grid: DataFrame) -> DataFrame:
    """Silver: target columns only, rows with a document up to the first run of 1000 rows without one."""
    sheet = grids.pick_sheet(grid, SHEET)
    table, names = grids.promote_header(sheet, HEADER, targets=INTERNSHIPS.columns, require_header=True)
    kept = rows.stop_after_blank_run(table, col("DNI"), BLANK_RUN)
    tidy = [
        (cells.sheet_date(col(n)) if n in DATES else cells.number_cell_text(col(n))).alias(n) for n in names
    ]
    return kept.select(*tidy)


def tenure(silver: DataFrame) -> DataFrame:
    """Gold without the final order."""
    started, renewed = col("FECHA ING"), col("F. RENOVACION")
    parts = silver.select(
        *[col(old).alias(new) for old, new in CARRIED.items()],
        *[c.alias(name) for name, c in calendar.tenure_parts(started, renewed).items()],
    )
    flagged = parts.withColumns(calendar.tenure_flags(col("CONDICION"), col("dias_servicio")))
    phrase = calendar.tenure_phrase(
        col("anios_servicio"), col("meses_servicio"), col("por_cumplir_1"), col("por_cumplir_2")
    )
    return flagged.withColumn("tiempo_servicio", phrase)


def gold(silver: DataFrame) -> DataFrame:
    done = tenure(silver)
    return done.orderBy(*order_of(done))


def order_of(gold_table: DataFrame) -> list[Column]:
    """Latest start first; documents tell people of one day, or of an unknown one, apart."""
    return [F.col("Fecha_Ingreso").desc_nulls_last(), F.col("DNI").asc_nulls_last()]


def flag_counts(gold_table: DataFrame) -> DataFrame:
    return condition_profile(gold_table, {f: F.col(f) == "SI" for f in FLAGS})


def findings(silver: DataFrame) -> list[str]:
    """Schema remarks; they inform and never block."""
    return quality.schema_findings(silver, INTERNSHIPS)


def run(grid: DataFrame, base: str, contract: SourceContract | None = None) -> dict[str, str]:
    """Checked sources, silver with its schema remarks, gold with its flag counts."""
    quality.preflight(grid, contract)
    silver = sinks.write_current(clean(grid), f"{base}/silver/control_practicantes_silver")
    path = f"{base}/gold/actual/control_practicantes_gold"
    done = tenure(silver)
    stored = sinks.write_current(done, path, order=order_of(done))
    remarks = grid.sparkSession.createDataFrame([(f,) for f in findings(silver)], "observacion string")
    reports = sinks.write_reports({"indicadores": flag_counts(stored), "esquema": remarks}, base, "practicantes")
    paths = {"silver": f"{base}/silver/control_practicantes_silver", "gold": path, **reports}
    sinks.missing_outputs(grid.sparkSession, paths)
    return paths
