"""Retirement exams: one sheet to a clean table, typed gold with derived periods, cost-centre enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions import calendar, cells
from padron.operators import catalog, quality, rows, shape
from padron.operators.aggregates import shares
from padron.operators.joins import BROADCAST_ROWS
from padron.plans.tables import COST_CENTRES, EXAM_DATES, EXAMS
from padron.session import col
from padron.sources import grid as grids
from padron.sources import sinks, tables
from padron.sources.contracts import SourceContract

SHEET = "DATA"
HEADER = grids.HeaderRule(row=3)
CODE = "NOMBRE DE CC"
# The order of the enriched table: by name, then by what tells people of one name apart.
ORDER = ("NOMBRE", "DNI", "FECHA DE CESE", "codigo_cc_original")
# Catalogue columns and the names they take in the enriched table.
CATALOGUE_NAMES = {
    "CC": "codigo_cc",
    "NOMBRE CC": "nombre_cc_completo",
    "CATEGORIA CC": "categoria_cc",
    "GERENCIA": "gerencia",
}


def clean(grid: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Silver: rows up to the first blank first cell of their sheet, errors and blanks normalised, digits kept.

    Dates are read with or without a time; ``strict_dates`` admits only the form with a time.
    """
    table, names = grids.promote_header(grids.pick_sheet(grid, SHEET), HEADER, require_header=True)
    kept = rows.stop_at_first(table, cells.is_blank(F.get("_row", F.lit(0))))

    def tidy(name: str):
        text = cells.printed_number_text(cells.error_cell_to_null(col(name)))
        if name in EXAM_DATES:
            return cells.datetime_text_to_date(text, date_only=not strict_dates)
        if name == "DNI":
            text = cells.strip_dot_zero(text)
        return F.coalesce(text, F.lit(""))

    return kept.select(*[tidy(n).alias(n) for n in names])


def gold(silver: DataFrame) -> tuple[DataFrame, list[str]]:
    """(typed table with AÑO, MES, NOMBRE_MES and the declared filters applied, missing columns)."""
    chosen, missing = shape.select_in_spec_order(silver, EXAMS.base)
    typed = shape.tolerant_cast(chosen, EXAMS.base)
    if "FECHA DE CESE" in typed.columns:
        ended = col("FECHA DE CESE")
        derived = {
            "AÑO": F.year(ended),
            "MES": F.month(ended),
            "NOMBRE_MES": calendar.month_name(F.month(ended)),
        }
        typed = typed.withColumns(derived)
    kept, _ = rows.declared_filters(typed, EXAMS.filters)
    return kept, missing


def unified_catalogue(current: DataFrame, older: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """One row per cost centre, the current catalogue first; ``order`` decides inside a catalogue.

    Without an order column the remaining columns decide, so that the outcome does not depend on layout.
    """
    columns = [*COST_CENTRES.columns, *order]
    picked = [shape.select_required(c, columns) for c in (current, older)]
    ranks = order or tuple(c for c in COST_CENTRES.columns if c != "CC")
    return catalog.merge_by_priority(picked, "CC", ranks).select(*[col(c) for c in COST_CENTRES.columns])


def enrich(exams: DataFrame, catalogue: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Exams with catalogue columns and match status; without the final order."""
    joined = catalog.enrich_with_catalogue(exams, catalogue, CODE, "CC", CATALOGUE_NAMES, max_rows=max_rows)
    return joined.withColumnRenamed(CODE, "codigo_cc_original")


def order_of(enriched: DataFrame) -> list[Column]:
    return [col(c).asc_nulls_last() for c in ORDER if c in enriched.columns]


def status_summary(enriched: DataFrame) -> DataFrame:
    return shares(enriched, "status_match")


def run(
    grid: DataFrame,
    current: DataFrame,
    older: DataFrame,
    base: str,
    contract: SourceContract | None = None,
    order: tuple[str, ...] = (),
) -> dict[str, object]:
    """Checked sources, silver, gold, enriched gold with its status summary; every output is looked up at the end."""
    quality.preflight(grid, contract)
    stamp = sinks.run_stamp()
    silver = sinks.write_current(clean(grid), f"{base}/silver/examenes_retiro_silver")
    typed, _ = gold(silver)
    paths: dict[str, object] = {"silver": f"{base}/silver/examenes_retiro_silver"}
    paths["gold"] = sinks.write_versioned(typed, f"{base}/gold", "examenes_retiro_gold", stamp)
    spark = grid.sparkSession
    stored = tables.read(spark, paths["gold"]["actual"])
    sinks.write_review(stored, f"{base}/gold/revision/examenes_retiro_gold")
    enriched = enrich(stored, unified_catalogue(current, older, order))
    paths["enriched"] = sinks.write_versioned(
        enriched, f"{base}/gold", "examenes_retiro_gold_enriquecido", stamp, order=order_of(enriched)
    )
    done = tables.read(spark, paths["enriched"]["actual"])
    paths["reportes"] = sinks.write_reports({"estado": status_summary(done)}, base, "examenes")
    sinks.missing_outputs(spark, sinks.flat_outputs(paths))
    return paths
