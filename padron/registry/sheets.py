"""Queries over raw sheet grids: headers, cuts, junk rows, source contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions import cells
from padron.operators import quality, rows
from padron.plans import employees
from padron.registry import sheet_frames as sheets
from padron.registry.common import Registry
from padron.registry.sheet_frames import cte
from padron.session import col
from padron.sources import grid as grids
from padron.sources.contracts import SheetContract, SourceContract

query = Registry()

_TURNS = cte("turns")

# ---- cuts and junk rows on bare rows -------------------------------------------------------------


@query(
    _TURNS
    + """SELECT t.file, row_idx, clave FROM turns t
LEFT JOIN (SELECT file, MIN(row_idx) AS cut FROM turns WHERE clave IS NULL OR trim(clave) = '' GROUP BY file) c
  ON t.file = c.file WHERE cut IS NULL OR row_idx < cut"""
)
def cut_first_blank_key(spark: SparkSession, folder: str) -> DataFrame:
    turns = sheets.turns(spark, folder)
    return rows.stop_at_first(turns, cells.is_blank(F.col("clave"))).select("file", "row_idx", "clave")


@query(
    _TURNS
    + """SELECT t.file, row_idx, clave, texto FROM turns t
LEFT JOIN (SELECT file, MIN(row_idx) AS cut FROM turns
    WHERE (clave IS NULL OR trim(clave) = '') AND (texto IS NULL OR trim(texto) = '') GROUP BY file) c
  ON t.file = c.file WHERE cut IS NULL OR row_idx < cut"""
)
def cut_first_blank_row(spark: SparkSession, folder: str) -> DataFrame:
    turns = sheets.turns(spark, folder)
    blank = cells.is_blank(F.col("clave")) & cells.is_blank(F.col("texto"))
    return rows.stop_at_first(turns, blank).select("file", "row_idx", "clave", "texto")


@query(cte("control_rows", "control_kept") + "SELECT o_orderkey AS id FROM control_kept")
def cut_blank_run(spark: SparkSession, folder: str) -> DataFrame:
    control = sheets.control_sheets(spark, folder).filter("row_idx > 4")
    kept = rows.stop_after_blank_run(control, F.get("cells", F.lit(2)))
    return kept.select(F.regexp_extract(F.get("cells", F.lit(1)), "^[0-9]+", 0).cast("bigint").alias("id"))


@query(_TURNS + "SELECT file, row_idx, clave FROM turns WHERE trim(clave) <> ''")
def drop_blank_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_blank_key(sheets.turns(spark, folder), F.col("clave")).select("file", "row_idx", "clave")


@query(
    cte("payroll_rows") + "SELECT file, n FROM payroll_rows WHERE n IS NOT NULL AND n <> 'Total general de la planilla'"
)
def skip_footer(spark: SparkSession, folder: str) -> DataFrame:
    payroll = sheets.payroll_rows(spark, folder)
    return payroll.filter(rows.is_data_row(F.col("n"))).select("file", "n")


# ---- headers -----------------------------------------------------------------------------------


@query(
    cte("master_rows")
    + """SELECT CASE WHEN doc = '' THEN ' ' ELSE ' ' || doc END AS "NUMERO DE DOC", modalidad AS "Modalidad de Contrato"
FROM master_rows"""
)
def header_first_blank(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = grids.promote_header(sheets.master_sheets(spark, folder), grids.HeaderRule(10))
    return table.select(col("NUMERO DE DOC"), col("Modalidad de Contrato"))


@query(
    """SELECT 'IGNORADA,Modalidad de Contrato,NOMBRE' AS extra, 'z' AS ultima, COUNT(*) AS filas FROM orders"""
)
def header_skip_blank(spark: SparkSession, folder: str) -> DataFrame:
    """The column behind the blank header cell is read from its own position."""
    table, names = grids.promote_header(
        sheets.master_sheets(spark, folder), grids.HeaderRule(10, stop="skip_blank")
    )
    others = [n for n in names if n not in ("NUMERO DE DOC", "FECH_INGR.")]
    label = F.lit(",".join(sorted(others))).alias("extra")
    return table.groupBy(label, col("IGNORADA").alias("ultima")).agg(F.count(F.lit(1)).alias("filas"))


@query(
    """SELECT o_orderkey AS id, ' A' || o_custkey || ' ' AS "APELLIDOS Y NOMBRES", 'J' AS "JEFE INMEDIATO",
  'G' || (o_custkey % 3) AS GERENCIA FROM orders"""
)
def header_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Only target columns, found by cleaned name."""
    rule = grids.HeaderRule(4, stop="skip_blank", one_line=True)
    targets = ["N°", "APELLIDOS Y NOMBRES", "JEFE INMEDIATO", "GERENCIA"]
    table, _ = grids.promote_header(sheets.control_sheets(spark, folder), rule, targets)
    key = F.regexp_extract(col("N°"), "^[0-9]+", 0).cast("bigint")
    return table.select(key.alias("id"), *[col(t) for t in targets[1:]])


@query(
    cte("payroll_rows")
    + """SELECT file, sheet, dni AS "DNI/CEX", sexo AS SEXO, CASE WHEN impar = 1 THEN horas END AS "HORAS EXTRAS 25%",
  CASE WHEN impar = 0 THEN neto END AS NETO FROM payroll_rows"""
)
def header_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Files with different columns, one with a gap in its header, read into one table."""
    table, _ = grids.promote_header(sheets.payroll_sheets(spark, folder), grids.HeaderRule(6, stop="gap"))
    return table.select("file", "sheet", *[col(c) for c in ("DNI/CEX", "SEXO", "HORAS EXTRAS 25%", "NETO")])


@query(
    """SELECT o_custkey || '' AS DNI, 'F' AS SEXO, o_orderkey AS id FROM orders
WHERE NOT (strftime(o_orderdate, '%Y-%m') = '1995-03' AND o_orderkey % 5 = 2) UNION ALL SELECT ' ', ' ', o_orderkey FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1995-03' AND o_orderkey % 5 = 2"""
)
def header_from_second_column(spark: SparkSession, folder: str) -> DataFrame:
    sheet = grids.pick_sheet(sheets.income_sheets(spark, folder), "EMPLEADOS")
    table, _ = grids.promote_header(sheet, grids.HeaderRule(2, start_col=2))
    return table.select("DNI", "SEXO", (F.col("row_idx") - 3).alias("id"))


WIDE = 260


@query(
    f"""SELECT c_custkey AS id, 'v1_' || c_custkey AS "C1", 'v200_' || c_custkey AS "C200", 'v{WIDE}_' || c_custkey AS "C{WIDE}",
  {WIDE - 3} AS columnas FROM customer"""
)
def header_wide(spark: SparkSession, folder: str) -> DataFrame:
    """A header of more than 199 columns, with three gaps inside; the fourth would end it."""
    people = sheets.table(spark, folder, "customer").selectExpr(
        "concat('ancho ', c_nationkey, '.xlsx') AS file", "'Planilla' AS sheet", "c_custkey + 7 AS row_idx", "c_custkey"
    )
    header = f"transform(sequence(1, {WIDE}), i -> CASE WHEN i NOT IN (50, 150, 250) THEN concat('C', i) END)"
    values = [f"concat('v{i}_', c_custkey)" for i in range(1, WIDE + 1)]
    table, names = grids.promote_header(sheets.grid(people, 6, header, values), grids.HeaderRule(6, stop="gap"))
    return table.select(
        (F.col("row_idx") - 7).alias("id"), *[col(f"C{i}") for i in (1, 200, WIDE)], F.lit(len(names)).alias("columnas")
    )


_DRIFT_BLANK = "c_nationkey = 3 AND c_custkey % 4 = 1"


@query(
    f"""SELECT CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS "NUMERO DE DOC", 'N' || c_custkey AS "NOMBRE",
  CASE WHEN c_nationkey % 2 = 1 THEN CAST(c_custkey AS VARCHAR) END AS "NUMERO DOC."
FROM customer WHERE c_nationkey <> 3
  OR c_custkey < coalesce((SELECT MIN(c_custkey) FROM customer WHERE {_DRIFT_BLANK}), 9223372036854775807)"""
)
def employee_drifting_key(spark: SparkSession, folder: str) -> DataFrame:
    """Files that spell and place the document column differently; each ends at a blank in its own."""
    people = sheets.table(spark, folder, "customer").selectExpr(
        "concat('bd ', c_nationkey, '.xlsx') AS file", "'BD' AS sheet", "c_custkey + 11 AS row_idx", "c_nationkey % 2 AS impar",
        f"CASE WHEN {_DRIFT_BLANK} THEN '' ELSE cast(c_custkey AS string) END AS doc", "concat('N', c_custkey) AS nombre",
    )
    odd = "cast(nullif(regexp_extract(file, '([0-9]+)', 1), '') AS int) % 2 = 1"
    header = f"CASE WHEN {odd} THEN array('NOMBRE', 'NUMERO DOC.') ELSE array('NUMERO DE DOC', 'NOMBRE') END"
    cells_ = ["CASE WHEN impar = 1 THEN nombre ELSE doc END", "CASE WHEN impar = 1 THEN doc ELSE nombre END"]
    table = employees.clean(sheets.grid(people, 10, header, cells_))
    return table.select(col("NUMERO DE DOC"), col("NOMBRE"), col("NUMERO DOC."))


@query(
    """SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') AS PERIODO FROM orders"""
)
def period_from_path(spark: SparkSession, folder: str) -> DataFrame:
    """The period of a file's own name, though its folders hold another one, with either kind of slash."""
    files = sheets.table(spark, folder, "orders").selectExpr(
        r"""concat(CASE WHEN o_orderkey % 2 = 0 THEN '/raw/2019-12/' ELSE 'C:\\raw\\2019-12\\' END,
           'Planilla ', date_format(o_orderdate, 'yyyy-MM'), ' Empleados.xlsx') AS file""",
        "'Planilla' AS sheet", "o_orderkey AS row_idx",
    )
    return grids.with_period(files, "Planilla")[0].select(F.col("row_idx").alias("id"), "PERIODO")


@query(
    """SELECT o_orderkey AS id, o_custkey || '.' || rtrim(lpad(CAST(o_orderkey * 10 + 7 AS VARCHAR), 9, '0'), '0') AS decimales,
  CAST(o_custkey AS VARCHAR) AS entero, CAST(o_custkey * 100 AS VARCHAR) AS exponente, 'C' || o_custkey || '.50' AS texto FROM orders"""
)
def exam_number_text(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers keep all digits they are printed with."""
    orders = sheets.table(spark, folder, "orders")
    shown = {
        "decimales": "concat(' ', o_custkey, '.', lpad(o_orderkey * 10 + 7, 9, '0'), '00 ')",
        "entero": "concat(o_custkey, '.000')",
        "exponente": "concat(o_custkey, 'e2')",
        "texto": "concat('C', o_custkey, '.50 ')",
    }
    return orders.select(
        F.col("o_orderkey").alias("id"), *[cells.printed_number_text(F.expr(e)).alias(n) for n, e in shown.items()]
    )


# ---- files and contracts -----------------------------------------------------------------------

_NO_PERIOD = "NOT regexp_matches(file, '\\d{4}-\\d{2}')"


@query(
    cte("payroll_rows")
    + f"""SELECT DISTINCT file, CASE WHEN {_NO_PERIOD} THEN 'sin periodo' ELSE 'sin hoja Planilla' END AS motivo
FROM payroll_rows WHERE {_NO_PERIOD} OR sheet <> 'Planilla'"""
)
def rejected_files(spark: SparkSession, folder: str) -> DataFrame:
    return grids.with_period(sheets.payroll_sheets(spark, folder), "Planilla")[1]


@query(
    cte("payroll_rows")
    + """SELECT DISTINCT file FROM payroll_rows WHERE NOT starts_with(file, '~$') AND NOT starts_with(file, 'Consolidado')"""
)
def usable_files(spark: SparkSession, folder: str) -> DataFrame:
    return grids.usable_files(sheets.payroll_sheets(spark, folder), ["Consolidado"]).select("file").distinct()


CONTRACT = SourceContract(
    "planillas",
    "Planillas",
    (SheetContract("Planilla", 6, 1, ("dni/cex", "Neto", "NOMBRES")), SheetContract("Hoja1", 5, 1)),
    required_sheets=("Planilla",),
    allowed_sheets=("Planilla", "Resumen"),
    enforce_allowed=True,
    file_name_pattern=r"(?i)^.*(?:19|20)\d{2}-\d{2}.*\.(xlsx|xlsm|xls)$",
)


@query(
    cte("payroll_rows")
    + r""", s AS (SELECT DISTINCT file, sheet, impar FROM payroll_rows WHERE file <> 'Planilla sin fecha.xlsx'
  UNION SELECT 'Planilla sin fecha.xlsx', 'Planilla', 1)
SELECT file, NULL::VARCHAR AS sheet, 'file_name' AS rule, '(?i)^.*(?:19|20)\d{2}-\d{2}.*\.(xlsx|xlsm|xls)$' AS detail
FROM (SELECT DISTINCT file FROM s) WHERE NOT regexp_matches(file, '(19|20)\d{2}-\d{2}')
UNION ALL SELECT file, 'Planilla', 'missing_sheet', 'Planilla' FROM (SELECT DISTINCT file FROM s) f
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.file = f.file AND s.sheet = 'Planilla')
UNION ALL SELECT file, sheet, 'unexpected_sheet', sheet FROM s WHERE sheet NOT IN ('Planilla', 'Resumen')
UNION ALL SELECT file, sheet, 'shifted_header', '5:1' FROM s WHERE sheet = 'Hoja1'
UNION ALL SELECT file, sheet, 'missing_columns', CASE WHEN impar = 1 THEN 'Neto' ELSE 'NOMBRES' END FROM s
WHERE sheet = 'Planilla'"""
)
def source_contract(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_sources(sheets.payroll_sheets(spark, folder), CONTRACT)
