"""Source contracts, schema checks and constraint reports, all as DataFrames of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.functions import cells
from padron.operators.aggregates import condition_profile, duplicate_keys, invalid_values, null_profile, percent, shares
from padron.operators.row_rules import broken_tests
from padron.session import col
from padron.sources.contracts import HEADER_END_BLANKS, SheetContract, SourceContract
from padron.sources.grid import base_name
from padron.sources.specs import TableSpec

SHOWN_FINDINGS = 200
FINDING = "columna string, regla string, severidad string, cantidad bigint, detalle string"


class QualityError(ValueError):
    """Raised once, with every finding that fits the message."""


# ---- source contracts --------------------------------------------------------------------------


def check_sources(grid: DataFrame, contract: SourceContract) -> DataFrame:
    """(file, sheet, rule, detail) for every breach of the contract; a file of a wrong type gets no other check."""
    return check_contracts(grid, [contract]).drop("contract")


def check_contracts(grid: DataFrame, contracts: Sequence[SourceContract]) -> DataFrame:
    """(file, sheet, rule, detail, contract) for every breach of any contract, whatever their number, from one pass.

    The pass gives one line per file: its sheets, and the header rows that some contract speaks of. Cells are read for
    those rows only. All rules of all contracts are then worked out on that line.
    """
    rows = sorted({s.header_row for c in contracts for s in c.sheets})
    wanted = [(s.sheet, s.header_row) for c in contracts for s in c.sheets]
    sheets = grid.groupBy("file", "sheet").agg(F.lit(None).cast("bigint").alias("row"), F.lit(None).cast("array<string>").alias("cells"))
    heads = grid.filter(F.col("row_idx").isin(*rows)) if rows else grid.limit(0)
    if wanted:
        # Pairs of sheet and row as plain comparisons, which the scan can prune by.
        heads = heads.filter(reduce(or_, [(F.col("sheet") == s) & (F.col("row_idx") == r) for s, r in dict.fromkeys(wanted)]))
    lines = sheets.unionByName(heads.select("file", "sheet", F.col("row_idx").cast("bigint").alias("row"), "cells"))
    files = lines.groupBy("file").agg(
        F.collect_set("sheet").alias("sheets"),
        F.collect_list(F.when(F.col("row").isNotNull(), F.struct("sheet", "row", "cells"))).alias("heads"),
    )
    found = F.flatten(F.array(*[_breaches(c) for c in contracts]))
    return files.select("file", F.inline(found))


def _breaches(contract: SourceContract) -> Column:
    """All breaches of one contract by a file, as a list of (sheet, rule, detail, contract)."""

    def finding(rule: str, detail: Column, sheet: Column | None = None) -> Column:
        no_sheet = F.lit(None).cast("string")
        return F.struct(
            (no_sheet if sheet is None else sheet).alias("sheet"), F.lit(rule).alias("rule"),
            detail.cast("string").alias("detail"), F.lit(contract.id).alias("contract"),
        )

    def if_any(test: Column, one: Column) -> Column:
        return F.filter(F.array(F.when(test, one)), lambda f: f.isNotNull())

    def names(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    accepted = F.lower(F.regexp_extract("file", r"(\.[^./\\]+)$", 1)).isin(*contract.extensions)
    parts = []
    if contract.file_name_pattern:
        misnamed = ~base_name(F.col("file")).rlike(contract.file_name_pattern)
        parts.append(if_any(misnamed, finding("file_name", F.lit(contract.file_name_pattern))))
    if contract.must_exist:
        absent = F.array_except(names(contract.must_exist), F.col("sheets"))
        parts.append(F.transform(absent, lambda s: finding("missing_sheet", s, s)))
    if contract.enforce_allowed:
        surplus = F.array_except(F.col("sheets"), names(contract.may_exist))
        parts.append(F.transform(surplus, lambda s: finding("unexpected_sheet", s, s)))

    def header_breaches(s: SheetContract) -> list[Column]:
        head = F.filter("heads", lambda h: (h["sheet"] == s.sheet) & (h["row"] == s.header_row))
        row = F.coalesce(F.get(head, F.lit(0))["cells"], F.array().cast("array<string>"))
        there, sheet = F.array_contains("sheets", s.sheet), F.lit(s.sheet)
        shifted = there & cells.is_blank(F.get(row, F.lit(s.start_col - 1)))
        found = [if_any(shifted, finding("shifted_header", F.lit(f"{s.header_row}:{s.start_col}"), sheet))]
        if s.required:
            present = F.transform(_header_names(row, s), cells.header_key)
            lacking = F.filter(names(s.required), lambda r: ~F.array_contains(present, cells.header_key(r)))
            found.append(if_any(there & (F.size(lacking) > 0), finding("missing_columns", F.array_join(lacking, ", "), sheet)))
        return found

    for sheet_contract in contract.sheets:
        parts += header_breaches(sheet_contract)
    wrong_type = F.array(finding("extension", F.lit(", ".join(contract.extensions))))
    none = F.filter(wrong_type, lambda f: F.lit(False))
    return F.when(accepted, F.concat(*parts) if parts else none).otherwise(wrong_type)


def preflight(grid: DataFrame, *contracts: SourceContract | None) -> None:
    """Stops a job before it writes anything: no source files, or any breach of its contracts, all at once."""
    given = [c for c in contracts if c is not None]
    if not given:
        return
    if grid.isEmpty():
        raise QualityError("no source files given")
    raise_if_any(check_contracts(grid, given), "sources do not meet their contract")


def _header_names(row: Column, contract: SheetContract) -> Column:
    """Non-blank header cells from the start column, up to three blanks in a row after the first name."""
    width = F.lit(contract.max_cells + 1) if contract.max_cells else F.size(row) + 1
    scanned = F.slice(row, F.lit(contract.start_col), width)
    start = F.struct(F.array().cast("array<string>").alias("names"), F.lit(0).alias("blanks"))

    def step(state: Column, cell: Column) -> Column:
        ended = (F.size(state["names"]) > 0) & (state["blanks"] >= HEADER_END_BLANKS)
        blank = cells.is_blank(cell)
        names = F.when(ended | blank, state["names"]).otherwise(F.concat(state["names"], F.array(cell)))
        blanks = F.when(ended, state["blanks"]).when(blank, state["blanks"] + 1).otherwise(F.lit(0))
        return F.struct(names.alias("names"), blanks.alias("blanks"))

    return F.aggregate(scanned, start, step, lambda state: state["names"])


# ---- schema and constraint checks --------------------------------------------------------------


def schema_findings(df: DataFrame, spec: TableSpec, types: Sequence[str] = ("string", "date")) -> list[str]:
    """Missing columns, and columns whose type is not the declared one; looks at the schema only."""
    found = []
    actual = {f.name: f.dataType for f in df.schema.fields}
    for f in spec.fields:
        if f.name not in actual:
            found.append(f"missing column: {f.name}")
        elif f.type in types and not _fits(actual[f.name], f.type):
            found.append(f"column '{f.name}': expected {f.type}, found {actual[f.name].simpleString()}")
    return found


def schema_report(df: DataFrame, spec: TableSpec, types: Sequence[str] = ()) -> DataFrame:
    """(motivo, columna, filas): what :func:`schema_findings` says, undeclared columns, and columns with nulls.

    Schema remarks concern every row; their counts and the nulls come from one pass.
    """
    remarks = []
    for text in schema_findings(df, spec, types):
        reason, _, rest = text.partition(": ")
        remarks.append((reason, rest) if reason == "missing column" else (rest, reason.split("'")[1]))
    remarks += [("unexpected column", c) for c in df.columns if c not in spec.columns]
    profile = null_profile(df)
    nulls = profile.filter("nulos > 0").select(F.lit("nulls").alias("motivo"), "columna", F.col("nulos").alias("filas"))
    if not remarks:
        return nulls
    listed = F.array(*[F.struct(F.lit(r).alias("motivo"), F.lit(c).alias("columna")) for r, c in remarks])
    total = profile.agg(F.coalesce(F.max("total"), F.lit(0).cast("bigint")).alias("filas"))
    return total.select(F.inline(listed), "filas").select("motivo", "columna", "filas").unionByName(nulls)


def _fits(actual: T.DataType, declared: str) -> bool:
    families = {
        "string": (T.StringType,),
        "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
        "float": (T.FloatType, T.DoubleType),
        "boolean": (T.BooleanType,),
        "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    }
    return declared not in families or isinstance(actual, families[declared])


def constraint_findings(
    df: DataFrame,
    spec: TableSpec,
    warn_on: Sequence[str] = ("valores", "minimo"),
    strict_types: Sequence[str] = (),
    extras: bool = False,
    cross_rules: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(columna, regla, severidad, cantidad, detalle) for every broken rule of the specification.

    Rules: columna (missing), tipo, clave (duplicated primary key), unica (a further unique key), nulo, valores
    (allowed list), minimo, fila (the specification's rules over several columns, with severities of their own;
    a rule that speaks of an absent column is left out, since the column is reported itself);
    with ``extras`` also maximo and patron, the declared rules that are off by default. ``cross_rules``
    maps a rule name to the condition every row must meet. Row rules share one aggregate; nothing is
    evaluated before an action.
    """
    present = [f for f in spec.fields if f.name in df.columns]
    static = [
        (f.name, "columna", 1, "missing") for f in spec.fields if f.name not in df.columns
    ]
    types = TableSpec(spec.name, tuple(present))
    static += [(None, "tipo", 1, text) for text in schema_findings(df, types, strict_types)]

    tests: dict[tuple[str, str], tuple[Column, str]] = {}
    for f in present:
        c = col(f.name)
        if not f.nullable:
            tests[f.name, "nulo"] = (c.isNull(), "")
        if f.minimum is not None and _comparable(df, f.name):
            tests[f.name, "minimo"] = (c < F.lit(f.minimum), f"{f.minimum:g}")
        if extras and f.maximum is not None and _comparable(df, f.name):
            tests[f.name, "maximo"] = (c > F.lit(f.maximum), f"{f.maximum:g}")
        if extras and f.pattern:
            tests[f.name, "patron"] = (~c.cast("string").rlike(f.pattern), f.pattern)
    for name, rule in (cross_rules or {}).items():
        tests[name, "regla"] = (~rule, "")
    detail = {r.name: ", ".join(r.columns) for r in spec.row_rules}
    for name, broken in broken_tests(spec.row_rules, df.schema).items():
        tests[name, "fila"] = (broken, detail[name])
    own_severity = {r.name: r.severity for r in spec.row_rules}

    spark = df.sparkSession

    def severity(rule: Column) -> Column:
        told = F.when(rule.isin(*warn_on), F.lit("aviso"))
        if own_severity:
            names = F.create_map(*[F.lit(x) for pair in own_severity.items() for x in pair])
            told = told.when(rule == "fila", F.try_element_at(names, F.col("columna")))
        return told.otherwise(F.lit("error"))

    parts = []
    if static:
        parts.append(spark.createDataFrame(static, "columna string, regla string, cantidad bigint, detalle string"))
    if tests:
        labels = {f"{name}\n{rule}": test for (name, rule), (test, _) in tests.items()}
        details = F.create_map(*[F.lit(x) for (n, r), (_, d) in tests.items() for x in (f"{n}\n{r}", d)])
        counted = condition_profile(df, labels).filter(F.col("cantidad") > 0)
        parts.append(
            counted.select(
                F.split_part("indicador", F.lit("\n"), F.lit(1)).alias("columna"),
                F.split_part("indicador", F.lit("\n"), F.lit(2)).alias("regla"),
                "cantidad",
                F.try_element_at(details, "indicador").alias("detalle"),
            )
        )
    allowed = {f.name: f.allowed for f in present if f.allowed}
    if allowed:
        invalid = invalid_values(df, allowed)
        parts.append(invalid.select("columna", F.lit("valores").alias("regla"), "cantidad", F.col("ejemplos").alias("detalle")))
    key = [k for k in spec.primary_key if k in df.columns]
    if key:
        repeated = duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("cantidad")).filter(F.col("cantidad") > 0)
        parts.append(
            repeated.select(
                F.lit(", ".join(key)).alias("columna"),
                F.lit("clave").alias("regla"),
                "cantidad",
                F.lit("").alias("detalle"),
            )
        )
    for names in spec.unique_keys:
        if set(names) <= set(df.columns):
            known = df.filter(F.forall(F.array(*[col(n).isNotNull() for n in names]), lambda c: c))
            repeated = duplicate_keys(known, names).agg(F.count(F.lit(1)).alias("cantidad")).filter(F.col("cantidad") > 0)
            parts.append(
                repeated.select(F.lit(", ".join(names)).alias("columna"), F.lit("unica").alias("regla"), "cantidad", F.lit("").alias("detalle"))
            )
    if not parts:
        return spark.createDataFrame([], FINDING)
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report.select("columna", "regla", severity(F.col("regla")).alias("severidad"), "cantidad", "detalle")


def bad_values(df: DataFrame, spec: TableSpec, place: Sequence[str], extras: bool = False) -> DataFrame:
    """(columna, regla, valor, filas, primero): every distinct value that breaks a rule of its column, however many.

    Rules: valores (allowed list), minimo, and with ``extras`` maximo and patron. ``primero`` is the least ``place`` of
    such a row, its columns joined by spaces. Values are counted with partial sums and nothing is gathered.
    """
    entries = []
    for f in (f for f in spec.fields if f.name in df.columns):
        c, rules = col(f.name), {}
        if f.allowed:
            rules["valores"] = ~c.isin(*f.allowed)
        if f.minimum is not None and _comparable(df, f.name):
            rules["minimo"] = c < F.lit(f.minimum)
        if extras and f.maximum is not None and _comparable(df, f.name):
            rules["maximo"] = c > F.lit(f.maximum)
        if extras and f.pattern:
            rules["patron"] = ~c.cast("string").rlike(f.pattern)
        for rule, broken in rules.items():
            one = F.struct(F.lit(f.name).alias("columna"), F.lit(rule).alias("regla"), c.cast("string").alias("valor"))
            entries.append(F.when(broken, one))
    if not entries:
        return df.sparkSession.createDataFrame([], "columna string, regla string, valor string, filas bigint, primero string")
    where = F.concat_ws(" ", *[col(p).cast("string") for p in place if p in df.columns])
    found = df.select(where.alias("_place"), F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("_e"))
    return found.groupBy("_e.columna", "_e.regla", "_e.valor").agg(F.count(F.lit(1)).alias("filas"), F.min("_place").alias("primero"))


def _comparable(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def raise_if_any(findings: DataFrame, title: str, condition: Column | None = None) -> None:
    """Fails once with all findings in the message (the first ones, and a count, when there are very many)."""
    if condition is not None:
        findings = findings.filter(condition)
    shown = findings.limit(SHOWN_FINDINGS + 1).collect()
    if not shown:
        return
    lines = [" | ".join("" if v is None else str(v) for v in row) for row in shown[:SHOWN_FINDINGS]]
    if len(shown) > SHOWN_FINDINGS:
        lines.append(f"... {findings.count()} findings in total")
    raise QualityError("\n- ".join([title, *lines]))


# ---- summaries ---------------------------------------------------------------------------------


def flag_summary(df: DataFrame, flags: Sequence[str], modality: str, weight: str | None = None) -> DataFrame:
    """Rows, share per flag and distribution by contract type in one table (grupo, valor, cantidad, porcentaje).

    ``weight`` names a column that says how many rows each row stands for.
    """
    marked = condition_profile(df, {"total": F.lit(True), **{f: col(f) for f in flags}}, weight=weight)
    group = F.when(F.col("indicador") == "total", F.lit("total")).otherwise(F.lit("flag"))
    per_flag = marked.select(group.alias("grupo"), F.col("indicador").alias("valor"), "cantidad", "porcentaje")
    per_modality = shares(df, modality, weight=weight).select(
        F.lit("modalidad").alias("grupo"), col(modality).alias("valor"), "cantidad", "porcentaje"
    )
    return per_flag.unionByName(per_modality)


def stage_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in and out of a cleaning stage, then nulls per column of the result (medida, valor, porcentaje)."""
    rows_in = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = after.agg(F.count(F.lit(1)).alias("n"))
    kept = F.coalesce(F.round(F.lit(100.0) * F.col("n") / F.nullif(rows_in, F.lit(0)), 2), F.lit(0.0))
    rows = counted.select(
        F.inline(
            F.array(
                F.struct(F.lit("filas_entrada").alias("medida"), rows_in.alias("valor"), F.lit(100.0).alias("porcentaje")),
                F.struct(F.lit("filas_salida").alias("medida"), F.col("n").alias("valor"), kept.alias("porcentaje")),
            )
        )
    )
    nulls = null_profile(after).filter(F.col("nulos") > 0)
    return rows.unionByName(
        nulls.select(F.concat(F.lit("nulos: "), "columna").alias("medida"), F.col("nulos").alias("valor"), "porcentaje")
    )


# ---- reports from what was observed while a table was written ------------------------------------

NULLS = "nulos: "
FLAG = "flag: "


def null_measures(columns: Sequence[str]) -> dict[str, Column]:
    """What to observe for :func:`observed_nulls` and :func:`observed_stage`."""
    return {f"{NULLS}{c}": F.count_if(col(c).isNull()) for c in columns}


def flag_measures(flags: Sequence[str], weight: str | None = None) -> dict[str, Column]:
    """What to observe for :func:`observed_flag_summary`: rows in all, and rows per flag."""

    def rows(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, col(weight))), F.lit(0).cast("bigint")) if weight else F.count_if(test)

    return {f"{FLAG}total": rows(F.lit(True)), **{f"{FLAG}{f}": rows(col(f)) for f in flags}}


def _counted(spark: SparkSession, rows: Sequence[tuple[str, int]], label: str, value: str, whole: int) -> DataFrame:
    shape = f"`{label}` string, `{value}` bigint, total bigint"
    counted = spark.createDataFrame([(name, n, whole) for name, n in rows], shape)
    return counted.withColumn("porcentaje", percent(F.col(value), F.col("total")))


def observed_nulls(spark: SparkSession, metrics: Mapping[str, int]) -> DataFrame:
    """The null profile of a stored table, without reading it."""
    found = [(name.removeprefix(NULLS), n) for name, n in metrics.items() if name.startswith(NULLS)]
    return _counted(spark, found, "columna", "nulos", metrics["filas"]).select("columna", "nulos", "total", "porcentaje")


def observed_stage(spark: SparkSession, rows_in: int, metrics: Mapping[str, int]) -> DataFrame:
    """The stage report of a table whose input rows were observed in the same write."""
    rows = _counted(spark, [("filas_entrada", rows_in), ("filas_salida", metrics["filas"])], "medida", "valor", rows_in)
    whole = F.when(F.col("medida") == "filas_entrada", F.lit(100.0)).otherwise(F.col("porcentaje"))
    nulls = [(name, n) for name, n in metrics.items() if name.startswith(NULLS) and n]
    below = _counted(spark, nulls, "medida", "valor", metrics["filas"])
    columns = ["medida", "valor", "porcentaje"]
    return rows.withColumn("porcentaje", whole).select(columns).unionByName(below.select(columns))


def observed_flag_summary(stored: DataFrame, metrics: Mapping[str, int], modality: str, weight: str | None = None) -> DataFrame:
    """The flag summary of a stored table: totals from its write, only the distribution from its one narrow column."""
    found = [(name.removeprefix(FLAG), n) for name, n in metrics.items() if name.startswith(FLAG)]
    group = F.when(F.col("valor") == "total", F.lit("total")).otherwise(F.lit("flag")).alias("grupo")
    counted = _counted(stored.sparkSession, found, "valor", "cantidad", metrics[f"{FLAG}total"])
    per_modality = shares(stored, modality, weight=weight).select(
        F.lit("modalidad").alias("grupo"), col(modality).alias("valor"), "cantidad", "porcentaje"
    )
    return counted.select(group, "valor", "cantidad", "porcentaje").unionByName(per_modality)
