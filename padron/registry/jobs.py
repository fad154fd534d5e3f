"""Queries over the domain flows, from raw sheet grids to silver and gold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions.calendar import MONTHS
from padron.operators import quality
from padron.operators.rows import numbered
from padron.operators.shape import select_required
from padron.plans import cost_centres, employees, exams, income, internships, leaves, payroll
from padron.plans.tables import INTERNSHIPS
from padron.registry import frames
from padron.registry import sheet_frames as sheets
from padron.registry.common import Registry
from padron.registry.sheet_frames import cte
from padron.session import col, shared_folder
from padron.sources import sinks
from padron.sources.contracts import SheetContract, SourceContract
from padron.sources.sinks import review_frame

query = Registry()

OWN_OUTPUTS = ("Consolidado",)
_MONTHS = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
_INT = r"CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN CAST({c} AS BIGINT) END"
_DOUBLE = r"CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+(\.[0-9]*)?$') THEN CAST({c} AS DOUBLE) END"

# ---- payroll -----------------------------------------------------------------------------------

_PAYROLL = cte("payroll_rows", "payroll_kept", "payroll_silver")


@query(_PAYROLL + "SELECT * EXCLUDE (fecha) FROM payroll_silver")
def payroll_silver(spark: SparkSession, folder: str) -> DataFrame:
    return payroll.consolidate(sheets.payroll_sheets(spark, folder), OWN_OUTPUTS)[0]


@query(
    _PAYROLL
    + f"""SELECT PERIODO, "AÑO", CAST(MES AS BIGINT) AS MES, {_MONTHS}[MES] AS NOMBRE_MES, trim(NOMBRES) AS NOMBRES,
  "DNI/CEX", trim(SEXO) AS SEXO, fecha AS "F. NACIMIENTO", CAST("DIAS GOCE HABER(D)" AS BIGINT) AS "DIAS GOCE HABER(D)",
  "HORAS EXTRAS 25%" FROM payroll_silver"""
)
def payroll_gold(spark: SparkSession, folder: str) -> DataFrame:
    """The hours column holds a bad value and stays text; the days column becomes a number."""
    return review_frame(payroll.gold(payroll_silver(spark, folder))[0])


@query(
    _PAYROLL
    + f"""SELECT PERIODO, CAST(MES AS BIGINT) AS MES, {_MONTHS}[MES] AS NOMBRE_MES, "AÑO", "DNI/CEX", trim(SEXO) AS SEXO,
  fecha AS "F. NACIMIENTO", {_DOUBLE.format(c='"HORAS EXTRAS 25%"')} AS "HORAS EXTRAS 25%",
  {_DOUBLE.format(c="NETO")} AS NETO FROM payroll_silver"""
)
def mining_payroll_gold(spark: SparkSession, folder: str) -> DataFrame:
    return review_frame(payroll.mining_gold(payroll_silver(spark, folder))[0])


@query(
    _PAYROLL
    + """SELECT 'NOMBRES' AS columna, 'nulo' AS regla, 'error' AS severidad, COUNT(*) AS cantidad, '' AS detalle
FROM payroll_silver WHERE NOMBRES IS NULL
UNION ALL SELECT 'SEXO', 'valores', 'aviso', COUNT(*), 'X' FROM payroll_silver WHERE trim(SEXO) NOT IN ('M', 'F')
UNION ALL SELECT 'DIAS GOCE HABER(D)', 'minimo', 'aviso', COUNT(*), '0' FROM payroll_silver
  WHERE CAST("DIAS GOCE HABER(D)" AS BIGINT) < 0
UNION ALL SELECT 'PERIODO, DNI/CEX', 'clave', 'error', COUNT(*), '' FROM (
  SELECT 1 FROM payroll_silver GROUP BY PERIODO, "DNI/CEX" HAVING COUNT(*) > 1) HAVING COUNT(*) > 0
UNION ALL SELECT c, 'columna', 'error', 1, 'missing' FROM (VALUES ('CÓDIGO CORPORATIVO'), ('APELLIDO PATERNO'),
  ('APELLIDO MATERNO'), ('TIPO DE DOCUMENTO'), ('ÁREA'), ('CENTRO DE COSTOS'), ('FECHA DE INGRESO'), ('FECHA CESE'),
  ('MOTIVO CESE'), ('DIAS SUBSIDIO ENFERMEDAD'), ('# HRS EXTRAS SIMP.25%'), ('# HRS EXTRAS SIMP.35%'),
  ('#HRS EXTRAS DOBLES'), ('#HRS SIMP.50%'), ('HRS SIMPLES AL 50%'), ('HORAS EXTRAS 35%'), ('HORAS EXTRAS 100%'),
  ('LICENCIA GOCE HABER'), ('DIAS DIST.LIC.S.GH'), ('SUBS. POR ENFERMEDAD'), ('SUBS. POR ACCIDENTE')) AS v(c)"""
)
def payroll_findings(spark: SparkSession, folder: str) -> DataFrame:
    return payroll.findings(payroll.gold(payroll_silver(spark, folder))[0])


# ---- employee master ---------------------------------------------------------------------------

_MASTER = cte("master_rows", "master_silver")


@query(
    _MASTER
    + """SELECT doc AS "NUMERO DE DOC", nombre AS NOMBRE, ingreso AS "FECH_INGR.", modalidad AS "Modalidad de Contrato"
FROM master_silver"""
)
def employee_silver(spark: SparkSession, folder: str) -> DataFrame:
    return employees.clean(sheets.master_sheets(spark, folder)).drop("file", "sheet", "row_idx")


@query(
    _MASTER
    + """SELECT doc AS "NUMERO DE DOC", modalidad AS "Modalidad de Contrato",
  CAST(CAST(try_strptime(ingreso, '%Y-%m-%d %H:%M:%S') AS DATE) AS VARCHAR) AS "FECH_INGR.",
  CASE WHEN contains(modalidad, 'TERMINO DE CONVENIO') THEN 'practicantes' ELSE 'empleados' END AS salida
FROM master_silver WHERE modalidad IS NOT NULL"""
)
def employee_gold(spark: SparkSession, folder: str) -> DataFrame:
    staff, interns, _ = employees.gold(employees.clean(sheets.master_sheets(spark, folder)))
    both = staff.withColumn("salida", F.lit("empleados")).unionByName(
        interns.withColumn("salida", F.lit("practicantes"))
    )
    return review_frame(both)


# ---- income ------------------------------------------------------------------------------------

_INCOME = cte("income_rows", "income_employees")
_EMPLOYEE_COLUMNS = """PERIODO, CAST("AÑO" AS BIGINT) AS "AÑO", CAST(MES AS BIGINT) AS MES"""


@query(_INCOME + "SELECT * FROM income_employees")
def income_employees_silver(spark: SparkSession, folder: str) -> DataFrame:
    return income.clean(income.read_sheet(sheets.income_sheets(spark, folder), "EMPLEADOS"))


@query(
    _INCOME
    + f"""SELECT {_EMPLOYEE_COLUMNS}, CASE WHEN MES = '13' THEN '' ELSE {_MONTHS}[CAST(MES AS INTEGER)] END AS NOMBRE_MES,
  DNI, "N° DOCUM.", substr("FECHA NACIMIENTO", 1, 10) AS "FECHA NACIMIENTO", SEXO, DEPARTAMENTO, PROVINCIA, DISTRITO, CARGO,
  "ÁREA", "LUGAR DE TRABAJO", NULL::VARCHAR AS "FECHA INICIO", "WC/BC", "Tiempo de contrato",
  CASE WHEN SERVICIO IS NULL OR SERVICIO = '' THEN 'Personal_Interno' ELSE SERVICIO END AS SERVICIO, REGIMEN
FROM income_employees"""
)
def income_employees_gold(spark: SparkSession, folder: str) -> DataFrame:
    return review_frame(income.employees_gold(income_employees_silver(spark, folder)))


@query(
    f"""SELECT '2024-' || lpad(CAST(m AS VARCHAR), 2, '0') AS PERIODO, 2024::BIGINT AS "AÑO", m::BIGINT AS MES,
  CASE WHEN m BETWEEN 1 AND 12 THEN {_MONTHS}[m] ELSE '' END AS NOMBRE_MES, CAST(c_custkey AS VARCHAR) AS "Numero Documento",
  'M' AS "Sexo", 'Practicante' AS "Cargo", c_mktsegment AS "Área", NULL::VARCHAR AS "Jefe Directo",
  'Callao' AS "Lugar de Trabajo", CASE WHEN c_nationkey % 3 = 0 THEN 'POR DEFINIR' ELSE 'U' || c_nationkey END
    AS "Universidad de Procedencia", 'PRE' AS "Modalidad"
FROM (SELECT *, c_nationkey % 14 AS m FROM customer)"""
)
def income_interns_gold(spark: SparkSession, folder: str) -> DataFrame:
    silver = income.clean(income.read_sheet(sheets.income_sheets(spark, folder), "PRACTICANTES"))
    return income.interns_gold(silver)


# ---- leave -------------------------------------------------------------------------------------


@query(
    cte("leave_rows")
    + """SELECT periodo AS PERIODO, dni AS "DNI/CEX", 'P' AS "APELLIDO PATERNO", 'M' AS "APELLIDO MATERNO", 'N' AS NOMBRES,
  motivo AS MOTIVO, tipo AS TIPO_LICENCIA FROM leave_rows
WHERE dni IS NOT NULL AND periodo IS NOT NULL AND motivo IS NOT NULL"""
)
def leave_silver(spark: SparkSession, folder: str) -> DataFrame:
    return leaves.consolidate(sheets.leave_sheets(spark, folder))


# ---- internships -------------------------------------------------------------------------------


@query(
    cte("control_rows", "control_kept")
    + """SELECT o_orderkey || '.5' AS "N°", dni AS DNI, 'A' || o_custkey AS "APELLIDOS Y NOMBRES",
  o_orderpriority AS CONDICION, ingreso AS "FECHA ING", renovacion AS "F. RENOVACION", 'S1' AS SEDE,
  NULL::VARCHAR AS UNIVERSIDAD, 'J' AS "JEFE INMEDIATO", 'G' || (o_custkey % 3) AS GERENCIA FROM control_kept"""
)
def internship_silver(spark: SparkSession, folder: str) -> DataFrame:
    return review_frame(internships.clean(sheets.control_sheets(spark, folder)))


@query(
    """SELECT 'missing column' AS motivo, 'APELLIDOS Y NOMBRES' AS columna, COUNT(*) AS filas FROM orders
UNION ALL SELECT 'unexpected column', 'EXTRA', COUNT(*) FROM orders
UNION ALL SELECT 'nulls', 'UNIVERSIDAD', COUNT(*) FROM orders WHERE o_orderkey % 3 = 0"""
)
def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    """Schema remarks on a stored table: a declared column that is absent, an undeclared one, and one with nulls."""
    silver = frames.table(spark, folder, "orders").select(
        *[F.lit("x").alias(c) for c in INTERNSHIPS.columns if c not in ("APELLIDOS Y NOMBRES", "UNIVERSIDAD")],
        F.when(F.col("o_orderkey") % 3 != 0, F.lit("U")).alias("UNIVERSIDAD"),
        F.lit("x").alias("EXTRA"),
    )
    return quality.schema_report(silver, INTERNSHIPS)


@query(
    cte("control_rows")
    + """SELECT 'control' AS contract, 'control_' || file || '.xlsx' AS file, 'Practicantes' AS sheet, 'missing_columns' AS rule,
  'NO ESTA' AS detail FROM (SELECT DISTINCT file FROM control_rows)
UNION ALL SELECT 'control', 'control_' || file || '.xlsx', 'Resumen', 'missing_sheet', 'Resumen'
FROM (SELECT DISTINCT file FROM control_rows)"""
)
def preflight_report(spark: SparkSession, folder: str) -> DataFrame:
    """All breaches of many files at once, as the job's error lists them before anything is written."""
    contract = SourceContract(
        "control",
        "Control",
        (SheetContract("Practicantes", 4, 2, ("DNI", "NO ESTA")),),
        required_sheets=("Practicantes", "Resumen"),
    )
    grid = sheets.control_sheets(spark, folder)
    try:
        quality.preflight(grid, contract)
    except quality.QualityError as stopped:
        assert "missing_sheet" in str(stopped) and "missing_columns" in str(stopped)
    else:
        raise AssertionError("the contract is broken and the job was not stopped")
    return quality.check_sources(grid, contract).withColumn("contract", F.lit(contract.id))


@query(
    frames.cte("interns", "interns_days", "interns_parts", "interns_flags", "interns_phrase")
    + """SELECT DNI, "FECHA ING" AS "Fecha_Ingreso", CAST(row_number() OVER (ORDER BY "FECHA ING" DESC NULLS LAST, DNI NULLS LAST) AS BIGINT)
  AS puesto FROM interns_phrase"""
)
def internship_sorted_rank(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each row in the order in which the gold table is stored; the date is a date."""
    gold = internships.tenure(frames.interns(spark, folder))
    return numbered(gold, internships.order_of(gold), "puesto").select("DNI", "Fecha_Ingreso", "puesto")


# ---- exams -------------------------------------------------------------------------------------


@query(
    cte("exam_rows")
    + """SELECT nombre AS NOMBRE, dni AS DNI, cese AS "FECHA DE CESE", causa AS "CAUSA DE SALIDA", cargo AS CARGO,
  cc AS "NOMBRE DE CC" FROM exam_rows
WHERE file <> '1995-03'
  OR o_orderkey < coalesce((SELECT MIN(o_orderkey) FROM exam_rows WHERE nombre IS NULL), 9223372036854775807)"""
)
def exam_silver(spark: SparkSession, folder: str) -> DataFrame:
    return review_frame(exams.clean(sheets.exam_sheets(spark, folder)))


# ---- stored flows ------------------------------------------------------------------------------


@query(
    frames.cte("cc_old", "cc_new", "cc_unified", "exam_silver", "exam", "exam_enriched")
    + """SELECT NOMBRE, DNI, codigo_cc, status_match, copia FROM exam_enriched, (VALUES ('actual'), ('historico')) AS v(copia)"""
)
def exam_flow_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Typed exams stored, enriched from the stored copy, and both copies of the result read back."""
    base = shared_folder(spark, "exams")
    stored = sinks.write_current(exams.gold(frames.exam_silver(spark, folder))[0], f"{base}/gold/exams")
    current, older = frames.cc_new(spark, folder), frames.cc_old(spark, folder)
    enriched = exams.enrich(stored, exams.unified_catalogue(current, older, ("orden",)))
    paths = sinks.write_versioned(enriched, f"{base}/gold", "exams_enriched")
    copies = [spark.read.parquet(p).withColumn("copia", F.lit(c)) for c, p in paths.items()]
    wanted = ["NOMBRE", "DNI", "codigo_cc", "status_match", "copia"]
    return select_required(copies[0].unionByName(copies[1]), wanted)


@query(
    frames.cte("cc_old", "cc_new", "cc_unified", "exam_silver", "exam", "exam_enriched")
    + """SELECT NOMBRE, DNI, CAST("FECHA DE CESE" AS DATE) AS "FECHA DE CESE", CAST(row_number() OVER (
  ORDER BY NOMBRE NULLS LAST, DNI NULLS LAST, "FECHA DE CESE" NULLS LAST, codigo_cc_original NULLS LAST) AS BIGINT) AS puesto
FROM exam_enriched"""
)
def exam_sorted_rank(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each row in the order in which the enriched table is stored; the date is a date."""
    typed, _ = exams.gold(frames.exam_silver(spark, folder))
    current, older = frames.cc_new(spark, folder), frames.cc_old(spark, folder)
    enriched = exams.enrich(typed, exams.unified_catalogue(current, older, ("orden",)))
    return numbered(enriched, exams.order_of(enriched), "puesto").select("NOMBRE", "DNI", col("FECHA DE CESE"), "puesto")


_EXAM_RUN = cte("exam_rows") + """, kept AS (SELECT * FROM exam_rows WHERE file <> '1995-03'
  OR o_orderkey < coalesce((SELECT MIN(o_orderkey) FROM exam_rows WHERE nombre IS NULL), 9223372036854775807)),
enriched_run AS (SELECT * FROM kept)"""


@query(
    _EXAM_RUN
    + """SELECT tabla, filas FROM (SELECT 'silver' AS tabla, COUNT(*) AS filas FROM kept
UNION ALL SELECT 'historico', (SELECT COUNT(*) FROM enriched_run) UNION ALL SELECT 'actual', (SELECT COUNT(*) FROM enriched_run)
UNION ALL SELECT 'estado', (SELECT COUNT(*) FROM enriched_run))"""
)
def exam_run_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of what a whole run stores; the summary's counts add up to the enriched table."""
    grid, base = sheets.exam_sheets(spark, folder), shared_folder(spark, "exam-run")
    paths = exams.run(grid, frames.cc_new(spark, folder), frames.cc_old(spark, folder), base, order=("orden",))
    read, count = spark.read.parquet, F.count(F.lit(1)).alias("filas")
    parts = [
        read(paths["silver"]).agg(count).select(F.lit("silver").alias("tabla"), "filas"),
        *[read(paths["enriched"][c]).agg(count).select(F.lit(c).alias("tabla"), "filas") for c in ("historico", "actual")],
        read(paths["reportes"]["estado"]).agg(F.sum("cantidad").alias("filas")).select(F.lit("estado").alias("tabla"), "filas"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    _PAYROLL
    + """SELECT 'rechazados' AS reporte, file AS clave, CASE WHEN regexp_matches(file, '\\d{4}-\\d{2}') THEN 'sin hoja Planilla'
  ELSE 'sin periodo' END AS detalle, 1::BIGINT AS cantidad
FROM (SELECT DISTINCT file, sheet FROM payroll_rows WHERE NOT starts_with(file, '~$') AND NOT starts_with(file, 'Consolidado'))
WHERE NOT regexp_matches(file, '\\d{4}-\\d{2}') OR sheet <> 'Planilla'
UNION ALL SELECT 'notas', 'HORAS EXTRAS 25%', 'kept_as_text', 1
UNION ALL SELECT 'gold', 'filas', '', COUNT(*) FROM payroll_silver
UNION ALL SELECT 'hallazgos', 'NOMBRES', 'nulo', COUNT(*) FROM payroll_silver WHERE NOMBRES IS NULL"""
)
def payroll_run_reports(spark: SparkSession, folder: str) -> DataFrame:
    """A whole payroll run read back: rejected files, casting notes, constraint report and rows of gold."""
    paths = payroll.run(sheets.payroll_sheets(spark, folder), shared_folder(spark, "payroll-run"), own_outputs=OWN_OUTPUTS)
    read, one = spark.read.parquet, F.lit(1).cast("bigint")

    def rows(df: DataFrame, report: str, key, detail, count=one) -> DataFrame:
        return df.select(F.lit(report).alias("reporte"), key.alias("clave"), detail.alias("detalle"), count.alias("cantidad"))

    found = read(paths["hallazgos"]).filter("columna = 'NOMBRES' AND regla = 'nulo'")
    total = read(paths["gold"]).agg(F.count(F.lit(1)).alias("n"))
    notes = read(paths["notas"]).filter("nota = 'kept_as_text'")
    parts = [
        rows(read(paths["rechazados"]), "rechazados", F.col("file"), F.col("motivo")),
        rows(notes, "notas", F.col("columna"), F.col("nota")),
        rows(found, "hallazgos", F.col("columna"), F.col("regla"), F.col("cantidad")),
        rows(total, "gold", F.lit("filas"), F.lit(""), F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    _INCOME
    + """SELECT 'filas_salida' AS medida, COUNT(*) AS valor FROM income_employees
UNION ALL SELECT 'periodos', COUNT(DISTINCT PERIODO) FROM income_employees WHERE PERIODO IS NOT NULL
UNION ALL SELECT 'universidades', COUNT(*) FROM customer"""
)
def income_run_reports(spark: SparkSession, folder: str) -> DataFrame:
    """A whole income run read back: rows after cleaning, periods, and interns by university."""
    paths = income.run(sheets.income_sheets(spark, folder), shared_folder(spark, "income-run"))
    read = spark.read.parquet
    staff, students = paths["reportes_empleados"], paths["reportes_practicantes"]
    parts = [
        read(staff["etapa"]).filter("medida = 'filas_salida'").select("medida", "valor"),
        read(staff["periodos"]).filter("PERIODO IS NOT NULL").agg(F.count(F.lit(1)).alias("valor")).select(F.lit("periodos").alias("medida"), "valor"),
        read(students["universidades"]).agg(F.sum("cantidad").alias("valor")).select(F.lit("universidades").alias("medida"), "valor"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    frames.cte("cc_old")
    + """SELECT CC, "NOMBRE CC", copia FROM (
  SELECT *, row_number() OVER (PARTITION BY CC ORDER BY orden) AS rn FROM cc_old),
  (VALUES ('actual'), ('historico')) AS v(copia) WHERE rn = 1"""
)
def cost_centre_outputs(spark: SparkSession, folder: str) -> DataFrame:
    silver = frames.cc_old(spark, folder).withColumnRenamed("orden", "row_idx")
    paths = cost_centres.run(silver, shared_folder(spark, "cost-centres"))
    copies = [spark.read.parquet(p).withColumn("copia", F.lit(c)) for c, p in paths.items()]
    return copies[0].unionByName(copies[1]).select(col("CC"), col("NOMBRE CC"), "copia")
