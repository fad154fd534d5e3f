"""Leave records: two sheets to one checked table, and payroll enriched with leave reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions import cells
from padron.operators import quality, rows, shape
from padron.operators.aggregates import condition_profile, ordered_text
from padron.operators.joins import lookup_join
from padron.plans.tables import LEAVE_OUTPUTS, LEAVE_SHEETS, LEAVES
from padron.session import col
from padron.sources import grid as grids
from padron.sources import sinks, tables
from padron.sources.contracts import SourceContract

HEADER = grids.HeaderRule(row=2, stop="skip_blank")
DOCUMENT, PERIOD, REASON, KIND = "DNI/CEX", "PERIODO", "MOTIVO", "TIPO_LICENCIA"
JOIN_KEY = (DOCUMENT, PERIOD)
FAILED = "leave records do not meet their specification"


def read_sheet(grid: DataFrame, sheet: str, kind: str) -> DataFrame | None:
    """One leave sheet, filtered and tagged; None when the sheet is absent."""
    body = grid.filter(F.col("sheet") == sheet)
    if body.isEmpty():
        return None
    keyed = body.filter((F.col("row_idx") <= HEADER.row) | cells.has_text(F.get("cells", F.lit(0))))
    table, names = grids.promote_header(keyed, HEADER, keep=(), require_header=True)
    table = shape.rename_any(table.select(*[col(n) for n in names]), LEAVES.rename)
    table = table.withColumn(DOCUMENT, cells.strip_dot_zero(col(DOCUMENT)))
    for required in (REASON, DOCUMENT, PERIOD):
        if required in table.columns:
            table = rows.drop_blank_key(table, col(required))
    return shape.with_constants(table, {KIND: kind})


def consolidate(grid: DataFrame, check: str = "raise") -> DataFrame:
    """Silver leave table. Breaches of the specification stop the job unless ``check='report'``."""
    sheets = [read_sheet(grid, sheet, kind) for sheet, kind in LEAVE_SHEETS.items()]
    present = [s for s in sheets if s is not None]
    if not present:
        raise grids.SheetError("no leave sheet could be processed")
    silver, _ = shape.select_in_spec_order(shape.union_by_name(present), LEAVES)
    if check == "raise":
        quality.raise_if_any(findings(silver), FAILED)
    return silver


def findings(silver: DataFrame) -> DataFrame:
    return quality.constraint_findings(silver, LEAVES, warn_on=(), strict_types=("string", "integer", "date"))


def enrich(payroll: DataFrame, leaves: DataFrame, payroll_unique: bool = False) -> DataFrame:
    """Payroll with the reasons of paid and unpaid leave per person and period.

    Both texts come from one grouping and one join. ``payroll_unique`` says that payroll is already known
    to be unique by key, which saves the search for hot keys.
    """
    reasons = ordered_text(leaves, JOIN_KEY, REASON, KIND, LEAVE_OUTPUTS)
    return lookup_join(payroll, reasons, JOIN_KEY, check_size=False, spread_hot_keys=not payroll_unique)


def coverage(enriched: DataFrame) -> DataFrame:
    return condition_profile(enriched, {name: F.col(name).isNotNull() for name in LEAVE_OUTPUTS.values()})


def run(
    grid: DataFrame, payroll: DataFrame, base: str, contract: SourceContract | None = None, payroll_unique: bool = False
) -> dict[str, str]:
    """Checked sources; the sheets are read once into a table beside the published one.

    All rules look at that table. If it passes, it takes the published name without being written again; if not,
    its findings stay as a report and the published table as it was. ``payroll_unique`` is the outcome of payroll's
    own key rule.
    """
    quality.preflight(grid, contract)
    spark, silver = grid.sparkSession, f"{base}/silver/licencias_consolidadas"
    staged = sinks.stage(consolidate(grid, check="report"), silver)
    rows = staged.read()
    checks = {"hallazgos": findings(rows), "valores": quality.bad_values(rows, LEAVES, JOIN_KEY)}
    told = sinks.write_reports(checks, base, "licencias")
    try:
        # The message names a few; the table has every value.
        quality.raise_if_any(tables.read(spark, told["hallazgos"]), f"{FAILED} (all values in {told['valores']})")
    except quality.QualityError:
        staged.discard()
        raise
    leaves = staged.publish()
    path = f"{base}/gold/actual/nomina_licencias_gold"
    gold = sinks.write_current(enrich(payroll, leaves, payroll_unique), path, partition_by=[PERIOD])
    paths = {"silver": silver, "gold": path, **told}
    paths |= sinks.write_reports({"cobertura": coverage(gold)}, base, "licencias")
    sinks.missing_outputs(spark, paths)
    return paths
