"""Employee master: sheet grid to clean text, typed tables for employees and interns, and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions import calendar, cells, flag_rules
from padron.functions.flag_rules import DEFAULT, FlagRules
from padron.operators import quality, rows, shape
from padron.operators.aggregates import any_repeated
from padron.operators.joins import lookup_join
from padron.plans.tables import EMPLOYEES, INTERN_MODALITY
from padron.session import col
from padron.sources import grid as grids
from padron.sources import sinks, tables
from padron.sources.contracts import SourceContract

HEADER = grids.HeaderRule(row=10)
KEY, HIRED, ENDED, BORN, MODALITY = (
    "NUMERO DE DOC",
    "FECH_INGR.",
    "Fecha de Termino",
    "FECHA DE NAC.",
    "Modalidad de Contrato",
)
FLAGS = tuple(DEFAULT.columns)


def clean(grid: DataFrame, sheet: str | None = None, stop_rule: str = "first_blank_key") -> DataFrame:
    """Silver text table; each sheet ends at the first blank in its own document column.

    ``stop_rule='none'`` keeps every non-empty row instead.
    """
    if sheet is not None:
        grid = grids.pick_sheet(grid, sheet)
    table, names = grids.promote_header(grid, HEADER, key=_is_document, require_header=True)
    if stop_rule == "none":
        kept = table.filter(~grids.row_is_blank())
        return kept.select(*grids.GRID_COLUMNS, *[cells.null_words_to_null(col(n)).alias(n) for n in names])
    kept = rows.stop_at_first(table, cells.is_blank(F.col("_key")))
    tidy = [cells.null_words_to_null(cells.slash_date_to_datetime_text(col(n))).alias(n) for n in names]
    return kept.select(*grids.GRID_COLUMNS, *tidy)


def _is_document(header: Column) -> Column:
    """Whether a header names the document number, which files spell differently."""
    return F.upper(header).contains("NUMERO") & F.upper(header).contains("DOC")


def gold(silver: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """(employees, interns, missing columns): known columns, dates typed, split by contract type."""
    dated, missing = typed(silver)
    interns, employees = rows.split_by_text(dated, MODALITY, INTERN_MODALITY)
    return employees, interns, missing


def typed(silver: DataFrame) -> tuple[DataFrame, list[str]]:
    """(known columns with dates typed, missing columns)."""
    known, missing = shape.select_known(silver, EMPLOYEES)
    return shape.tolerant_cast(known, EMPLOYEES), missing


def branches(dated: DataFrame) -> dict[str, Column]:
    """Which of the two gold tables a row goes to, by its contract type; one without a contract type goes to neither."""
    if MODALITY not in dated.columns:
        raise ValueError(f"column '{MODALITY}' is missing")
    intern = col(MODALITY).contains(INTERN_MODALITY)
    return {"bd_empleados_gold": ~intern, "bd_practicantes_gold": intern}


def flag_columns(as_of: Column, rules: FlagRules = DEFAULT) -> list[dict[str, Column]]:
    """The three calculations by document: service text, age flags, contract alerts."""
    years = calendar.service_years(col(HIRED), col(ENDED), as_of)
    return [
        {"tiempo_servicio_texto": calendar.service_text(col(HIRED), col(ENDED), as_of)},
        flag_rules.age_columns(rules, col(BORN), col(MODALITY), as_of),
        flag_rules.contract_columns(rules, col(MODALITY), years, as_of),
    ]


def flags(employees: DataFrame, as_of: str | None = None, mode: str = "auto", rules: FlagRules = DEFAULT) -> DataFrame:
    """Employees with service text and the age flags and contract alerts of the rules.

    The result is defined as the table joined three times to its own calculations by document number. With
    unique documents that is a projection (rows without a document get nulls), which needs no shuffle.
    A document held n times would fan out to n**4 rows; 'counted' gives the same result with equal rows merged:
    a ``repeticiones`` column says how often the joined form repeats each row. 'auto' checks uniqueness and
    counts only when documents repeat; 'projection' and 'counted' force one form.
    """
    lacking = shape.missing_columns(employees, [KEY, BORN, HIRED, ENDED, MODALITY])
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    if mode == "auto":
        mode = "counted" if any_repeated(employees, [KEY]) else "projection"
    parts = flag_columns(calendar.as_of_date(as_of), rules)
    if mode == "projection":
        has_key = col(KEY).isNotNull()
        return employees.withColumns({name: F.when(has_key, c) for part in parts for name, c in part.items()})
    return _counted_flags(employees, parts)


def _counted_flags(employees: DataFrame, calculations: list[dict[str, Column]]) -> DataFrame:
    """The three joins with equal calculations of a document merged and counted beforehand.

    A document's calculations become one lookup row of three short lists: texts of whole years and months, and
    combinations of flags. The lookup spreads hot documents, and rows without a document, over many tasks.
    """
    parts = [list(c) for c in calculations]
    known = employees.filter(col(KEY).isNotNull()).withColumns({n: c for part in calculations for n, c in part.items()})
    every = [n for names in parts for n in names]
    shape = {n: known.schema[n].dataType for n in every}
    # One row per calculation, with the columns of the others empty, so that all three are counted by one grouping.
    tagged = [
        F.struct(F.lit(i).alias("_part"), *[(col(n) if n in names else F.lit(None).cast(shape[n])).alias(n) for n in every])
        for i, names in enumerate(parts)
    ]
    counted = (
        known.select(col(KEY), F.inline(F.array(*tagged)))
        .groupBy(col(KEY), "_part", *[col(n) for n in every]).agg(F.count(F.lit(1)).alias("_times"))
    )
    sides = [
        F.collect_list(F.when(F.col("_part") == i, F.struct(*[col(n) for n in names], "_times"))).alias(f"_side{i}")
        for i, names in enumerate(parts)
    ]
    lookup = counted.groupBy(col(KEY)).agg(*sides)
    result = lookup_join(employees, lookup, [KEY], check_size=False)
    times = F.lit(1).cast("bigint")
    for i in range(len(parts)):
        result = result.withColumn(f"_p{i}", F.explode_outer(f"_side{i}"))
        times = times * F.coalesce(F.col(f"_p{i}._times"), F.lit(1).cast("bigint"))
    picked = [F.col(f"_p{i}").getField(n).alias(n) for i, names in enumerate(parts) for n in names]
    return result.select(*[col(c) for c in employees.columns], *picked, times.alias("repeticiones"))


def run(
    grid: DataFrame,
    base: str,
    sheet: str | None = None,
    as_of: str | None = None,
    mode: str = "auto",
    contract: SourceContract | None = None,
    rules: FlagRules = DEFAULT,
) -> dict[str, object]:
    """Checked sources, silver, both gold tables, the flags table and its summary, each stored; returns their paths."""
    quality.preflight(grid, contract)
    silver = sinks.write_current(clean(grid, sheet), f"{base}/silver/bd_silver")
    spark, stamp = grid.sparkSession, sinks.run_stamp()
    paths: dict[str, object] = {"silver": f"{base}/silver/bd_silver"}
    dated, _ = typed(silver)
    paths |= sinks.write_branches(dated, branches(dated), f"{base}/gold", stamp)
    if "bd_empleados_gold" in paths:
        stored = tables.read(spark, paths["bd_empleados_gold"]["actual"])
        flagged = flags(stored, as_of, mode, rules)
        weight = _weight(flagged)
        paths["flags"] = sinks.write_versioned(
            flagged, f"{base}/gold", "bd_empleados_flags_gold", stamp, observe=quality.flag_measures(rules.columns, weight)
        )
        done = tables.read(spark, paths["flags"]["actual"])
        told = quality.observed_flag_summary(done, tables.metrics(spark, paths["flags"]["actual"]), MODALITY, weight)
        paths["reportes"] = sinks.write_reports({"resumen": told}, base, "empleados")
    sinks.missing_outputs(spark, sinks.flat_outputs(paths))
    return paths


def _weight(flagged: DataFrame) -> str | None:
    return "repeticiones" if "repeticiones" in flagged.columns else None


def summary(flagged: DataFrame, rules: FlagRules = DEFAULT) -> DataFrame:
    """Counts and shares of the joined form; merged rows count as often as it repeats them."""
    return quality.flag_summary(flagged, rules.columns, MODALITY, _weight(flagged))
