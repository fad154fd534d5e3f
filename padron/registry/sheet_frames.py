"""Raw sheet grids derived from the given tables, in Spark, and the same rows as plain SQL tables.

Grids have many files, mostly one a month; a row that ends its sheet is in one of them, so the rest of the table
passes through. They are stored before use, as raw sheets are in a real run. The SQL side describes the cells by name instead of position; what a grid operator
must produce is then a plain query over it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.registry.frames import table
from padron.session import shared_folder
from padron.sources.grid import read_grid


# The files of one month have a row that ends the sheet.
CUT_MONTH = "date_format(o_orderdate, 'yyyy-MM') = '1995-03'"
# Rows left out after the 100th row of two files: more than the run that ends a sheet, and just fewer.
CONTROL_GAP = (
    "CASE WHEN o_orderkey {div} 500 = 3 AND o_orderkey % 500 >= 100 THEN 2000"
    " WHEN o_orderkey {div} 500 = 4 AND o_orderkey % 500 >= 100 THEN 900 ELSE 0 END"
)


def grid(rows: DataFrame, header_row: int, header: Sequence[str | None] | str, cells: Sequence[str]) -> DataFrame:
    """Data rows plus one header row per sheet; ``header`` is a list of names or an expression over file and sheet."""
    data = rows.selectExpr("file", "sheet", "row_idx", f"cast(array({', '.join(cells)}) AS array<string>) AS cells")
    names = (
        F.expr(header) if isinstance(header, str) else F.array(*[F.lit(h) for h in header]).cast("array<string>")
    )
    headers = rows.select("file", "sheet").distinct().select(
        "file", "sheet", F.lit(header_row).cast("bigint").alias("row_idx"), names.alias("cells")
    )
    return data.unionByName(headers)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(name: str):
    """Writes a derived grid to the shared folder once per application, and reads it from there."""

    def wrap(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def read(spark: SparkSession, folder: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, folder, name)
            if key not in _STORED:
                path = shared_folder(spark, f"raw-{name}")
                build(spark, folder).write.parquet(path)
                _STORED[key] = path
            return read_grid(spark, _STORED[key])

        return read

    return wrap


# ---- conversations: bare grid without header ---------------------------------------------------------


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").selectExpr(
        "concat('conv_', conv_id) AS file", "'chat' AS sheet", "turn AS row_idx",
        "CASE WHEN length(text) % 4 = 0 THEN ' ' WHEN length(text) % 7 = 0 THEN NULL ELSE role END AS clave",
        "CASE WHEN length(text) % 5 = 0 THEN NULL ELSE text END AS texto",
    )


# ---- payroll: monthly files from orders ------------------------------------------------------------

PAYROLL_ODD = "array('N°', 'DNI/CEX', 'NOMBRES', NULL, 'HORAS EXTRAS 25%', 'SEXO')"
PAYROLL_EVEN = "array('N°', ' DNI/CEX ', 'SEXO', 'DIAS GOCE HABER(D)', 'F. NACIMIENTO', 'NETO', 'CONCEPTO')"


def payroll_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        """CASE WHEN year(o_orderdate) = 2001 THEN 'Planilla sin fecha.xlsx'
           WHEN date_format(o_orderdate, 'yyyy-MM') = '1996-02' THEN '~$Planilla 1996-02 Empleados.xlsx'
           WHEN date_format(o_orderdate, 'yyyy-MM') = '1996-03' THEN 'Consolidado 1996-03.xlsx'
           ELSE concat('Planilla ', date_format(o_orderdate, 'yyyy-MM'), ' Empleados.xlsx') END AS file""",
        "CASE WHEN date_format(o_orderdate, 'yyyy-MM') = '1997-05' THEN 'Hoja1' ELSE 'Planilla' END AS sheet",
        "o_orderkey + 7 AS row_idx", "CASE WHEN year(o_orderdate) = 2001 THEN 1 ELSE month(o_orderdate) % 2 END AS impar",
        """CASE WHEN o_orderkey % 89 = 3 THEN 'Total general de la planilla' WHEN o_orderkey % 83 = 2 THEN NULL
           ELSE cast(o_orderkey AS string) END AS n""",
        "CASE WHEN o_orderkey % 59 = 4 THEN NULL ELSE cast(o_custkey AS string) END AS dni",
        "concat(' NOM ', o_custkey) AS nombres",
        "CASE WHEN o_orderkey % 71 = 0 THEN 'abc' ELSE concat(o_custkey, '.5') END AS horas",
        "CASE o_orderkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN ' M ' WHEN 3 THEN 'X' END AS sexo",
        "cast(o_custkey % 31 - 1 AS string) AS dias",
        """CASE WHEN o_orderkey % 7 = 0 THEN 's/f' WHEN o_orderkey % 7 = 1 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss.SSS')
           ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS nacimiento""",
        "CASE WHEN o_orderkey % 73 = 0 THEN '-' ELSE cast(o_custkey * 2 AS string) END AS neto",
        "o_orderpriority AS concepto",
    )


@stored("payroll")
def payroll_sheets(spark: SparkSession, folder: str) -> DataFrame:
    rows = payroll_rows(spark, folder)
    month = "cast(nullif(regexp_extract(file, '-([0-9][0-9])', 1), '') AS int)"
    header = f"CASE WHEN file LIKE '%sin fecha%' OR {month} % 2 = 1 THEN {PAYROLL_ODD} ELSE {PAYROLL_EVEN} END"
    cells = [
        "n",
        "dni",
        "CASE WHEN impar = 1 THEN nombres ELSE sexo END",
        "CASE WHEN impar = 1 THEN 'relleno' ELSE dias END",
        "CASE WHEN impar = 1 THEN horas ELSE nacimiento END",
        "CASE WHEN impar = 1 THEN sexo ELSE neto END",
        "CASE WHEN impar = 0 THEN concepto END",
    ]
    return grid(rows, 6, header, cells)


# ---- payroll with files that cannot be used --------------------------------------------------------

# Months whose file has no header row, and whose file calls the key column otherwise.
HEADLESS, KEYLESS = "1996-05", "1996-06"


def damaged_payroll_sheets(spark: SparkSession, folder: str) -> DataFrame:
    sheets = payroll_sheets(spark, folder).filter(f"NOT (file LIKE '%{HEADLESS}%' AND row_idx = 6)")
    renamed = F.transform("cells", lambda c: F.when(F.trim(c) == "DNI/CEX", F.lit("DOCUMENTO")).otherwise(c))
    return sheets.withColumn("cells", F.when(F.expr(f"file LIKE '%{KEYLESS}%' AND row_idx = 6"), renamed).otherwise(F.col("cells")))


# ---- payroll with ends of employment, and mining payroll with its own columns -----------------------------

LEAVER_HEADER = (
    "N°", "DNI/CEX", "APELLIDO PATERNO", "NOMBRES", "TIPO DE DOCUMENTO", "FECHA DE INGRESO", "FECHA CESE", "MOTIVO CESE",
)


@stored("leavers")
def leaver_sheets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "concat('Planilla ', date_format(o_orderdate, 'yyyy-MM'), ' Cese.xlsx') AS file", "'Planilla' AS sheet",
        "o_orderkey + 7 AS row_idx", "cast(o_orderkey AS string) AS n", "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS ingreso",
        """date_format(CASE o_orderkey % 4 WHEN 1 THEN date_add(o_orderdate, 30) WHEN 2 THEN date_add(o_orderdate, -1)
           WHEN 3 THEN cast(o_orderdate AS date) END, 'yyyy-MM-dd HH:mm:ss') AS cese""",
        "CASE o_orderkey % 3 WHEN 0 THEN 'RENUNCIA' WHEN 1 THEN ' ' END AS motivo",
    )
    return grid(rows, 6, LEAVER_HEADER, ["n", "n", "'P'", "'N'", "'DNI'", "ingreso", "cese", "motivo"])


MINING_HEADER = (
    "N°", "CÓDIGO CORPORATIVO", "DNI/CEX", "SEXO", "F. NACIMIENTO", "PUESTO", "SEDE", "ÁREA", "CENTRO DE COSTOS",
    "DESC. CENTRO DE COSTO", "FECHA DE INGRESO", "DIAS TRABAJADOS", "DIAS DESC MEDICO (P)", "# HRS EXTRAS SIMP.25%",
    "# HRS EXTRAS SIMP.35%", "HORAS EXTRAS 25%", "HORAS EXTRAS 35%", "#HRS EXTRAS DOBLES", "HORAS EXTRAS 100%",
    "DESCANSO MEDICO", "TOTAL INGRESOS", "TOTAL DESCUENTOS", "TOTAL APORTACIONES", "NETO",
)


@stored("mining")
def mining_sheets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "concat('Mina ', date_format(o_orderdate, 'yyyy-MM'), '.xlsx') AS file", "'Planilla' AS sheet",
        "o_orderkey + 7 AS row_idx", "cast(o_orderkey AS string) AS n", "o_custkey", "o_orderkey",
        """date_format(CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN date_add(last_day(o_orderdate), 1)
           ELSE cast(o_orderdate AS date) END, 'yyyy-MM-dd HH:mm:ss') AS ingreso""",
        "CASE WHEN o_orderkey % 19 <> 0 THEN cast(o_custkey % 100 AS string) END AS descuentos",
        """CASE WHEN o_orderkey % 31 = 0 THEN '-5' ELSE cast(cast(o_custkey + 1000 - o_custkey % 100 + CASE
           WHEN o_orderkey % 29 = 0 THEN 2 WHEN o_orderkey % 5 = 0 THEN 0.01 ELSE 0 END AS decimal(14, 2)) AS string) END AS neto""",
    )
    zero = ["'0'"] * 8
    cells = [
        "n", "concat('C', o_custkey)", "n", "CASE WHEN o_orderkey % 2 = 0 THEN 'M' ELSE 'F' END", "'1980-01-02 00:00:00'",
        "'OPERARIO'", "'S1'", "'A1'", "concat('CC', o_custkey % 7)", "'desc'", "ingreso", "cast(o_orderkey % 35 AS string)",
        *zero, "cast(o_custkey + 1000 AS string)", "descuentos", "cast(o_custkey % 9 AS string)", "neto",
    ]
    return grid(rows, 6, MINING_HEADER, cells)


# ---- employee master, from orders ------------------------------------------------------------------

MASTER_HEADER = ("NUMERO DE DOC", "NOMBRE", "FECH_INGR.", "Modalidad de Contrato", None, "IGNORADA")


@stored("master")
def master_sheets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "concat('bd_', date_format(o_orderdate, 'yyyy-MM'), '.xlsx') AS file", "'BD' AS sheet", "o_orderkey + 11 AS row_idx",
        f"CASE WHEN {CUT_MONTH} AND o_orderkey % 5 = 2 THEN ' ' ELSE concat(' ', o_orderkey) END AS doc",
        "CASE o_orderkey % 6 WHEN 0 THEN 'None' WHEN 1 THEN 'nan' WHEN 2 THEN NULL ELSE concat('N', o_custkey, ' ') END AS nombre",
        """CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'd/M/yyyy') WHEN 1 THEN '31/02/2024'
           WHEN 2 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS ingreso""",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'TERMINO DE CONVENIO' WHEN o_orderpriority <> '2-HIGH' THEN o_orderpriority END AS modalidad",
    )
    cells = ["doc", "nombre", "ingreso", "modalidad", "NULL", "'z'"]
    return grid(rows, 10, MASTER_HEADER, cells)


# ---- internship control, from orders ----------------------------------------------------------------

CONTROL_HEADER = (
    None, "N°", "DNI ", "APELLIDOS\n Y  NOMBRES", "CONDICION", "EXTRA", "FECHA ING", "F. RENOVACION",
    "SEDE", "UNIVERSIDAD", "JEFE\r\nINMEDIATO", "GERENCIA",
)


@stored("control")
def control_sheets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "concat('control_', o_orderkey div 500, '.xlsx') AS file", "'Practicantes' AS sheet",
        f"o_orderkey % 500 + 5 + {CONTROL_GAP.format(div='div')} AS row_idx",
        "CASE WHEN o_orderkey < 20 OR o_orderkey % 53 = 0 THEN '  ' ELSE concat(o_orderkey, '.0') END AS dni",
        "o_orderkey", "o_custkey", "o_orderpriority",
        """CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
           WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy') WHEN 2 THEN date_format(o_orderdate, 'dd.MM.yyyy')
           WHEN 3 THEN cast(34700 + o_orderkey % 2000 AS string) ELSE NULL END AS ingreso""",
    )
    cells = [
        "NULL", "concat(o_orderkey, '.50')", "dni", "concat(' A', o_custkey, ' ')", "o_orderpriority", "'x'", "ingreso",
        "concat(cast(35000 + o_custkey % 1000 AS string), '.0')", "'S1'", "NULL", "'J'", "concat('G', o_custkey % 3)",
    ]
    return grid(rows, 4, CONTROL_HEADER, cells)


# ---- income relation, from orders and customer --------------------------------------------------------

EMPLOYEE_INCOME_HEADER = (
    None, "AÑO", "MES", "DNI", "N° DOCUM.", "FECHA NACIMIENTO", "SEXO", "DEPARTAMENTO", "PROVINCIA", "DISTRITO", "CARGO",
    "ÁREA", "LUGAR DE TRABAJO", "FECHA INICIO", "WC/BC", "Tiempo de contrato", "SERVICIO", "REGIMEN", "PROYECTO",
    "CODIGO SAP",
)
INTERN_INCOME_HEADER = (
    "AÑO", "MES", "Numero Documento", "Sexo", "Cargo", "Área", "Jefe Directo", "Lugar de Trabajo",
    "Universidad de Procedencia", "Modalidad", "CODIGO SAP",
)


@stored("income")
def income_sheets(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "orders").selectExpr(
        "concat('Relacion ', date_format(o_orderdate, 'yyyy-MM'), '.xlsx') AS file", "'EMPLEADOS' AS sheet",
        "o_orderkey + 3 AS row_idx", "*", f"{CUT_MONTH} AND o_orderkey % 5 = 2 AS vacia",
    )
    values = [
        "cast(year(o_orderdate) AS string)",
        "CASE WHEN o_orderkey % 31 = 0 THEN '13' WHEN o_orderkey % 37 = 0 THEN NULL ELSE cast(month(o_orderdate) AS string) END",
        "cast(o_custkey AS string)", "concat('D', o_custkey)", "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')", "'F'",
        "'Lima'", "NULL", "''", "o_orderpriority", "'A'", "'L'", "'2020-02-30 00:00:00'", "'WC'", "NULL",
        "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE 'S' END", "'R'",
        "CASE o_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN ' ' WHEN 2 THEN NULL ELSE 'P1' END",
        "CASE o_orderkey % 4 WHEN 0 THEN '#N/D' WHEN 1 THEN 'Error' WHEN 2 THEN NULL ELSE 'C9' END",
    ]
    employees = ["'marca'", *[f"CASE WHEN vacia THEN ' ' ELSE {v} END" for v in values]]
    students = table(spark, folder, "customer").selectExpr(
        "'Relacion.xlsx' AS file", "'PRACTICANTES' AS sheet", "c_custkey + 3 AS row_idx", "*"
    )
    intern_values = [
        "'2024'", "cast(c_nationkey % 14 AS string)", "cast(c_custkey AS string)", "'M'", "'Practicante'", "c_mktsegment",
        "NULL", "'Callao'", "CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE concat('U', c_nationkey) END", "'PRE'",
        "'#N/A'",
    ]
    staff = grid(people, 2, EMPLOYEE_INCOME_HEADER, employees)
    return staff.unionByName(grid(students, 2, INTERN_INCOME_HEADER, intern_values))


# ---- leave, from lineitem ---------------------------------------------------------------------------

PAID_HEADER = (
    "DNI/CEX", None, "PERIODO", "APELLIDO PATERNO", "APELLIDO MATERNO", "NOMBRES", "MOTIVO DE LIC.CON GOCE",
)
UNPAID_HEADER = (
    "DNI/CEX", "PERIODO", "APELLIDO PATERNO", "APELLIDO MATERNO", "NOMBRES", "MOTIVO DE LIC.S.G.H", "OBS",
)


@stored("leave")
def leave_sheets(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").selectExpr(
        "'Licencias.xlsx' AS file",
        "CASE WHEN l_linestatus = 'F' THEN 'LICENCIA CON GOCE' ELSE 'LICENCIA SIN GOCE' END AS sheet",
        "l_orderkey * 10 + l_linenumber + 3 AS row_idx",
        "CASE WHEN l_suppkey % 23 = 0 THEN ' ' ELSE concat(l_partkey, '.0') END AS dni",
        "CASE WHEN l_suppkey % 29 = 0 THEN '' ELSE date_format(l_shipdate, 'yyyy-MM') END AS periodo",
        "CASE WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN '  ' WHEN l_linenumber = 4 AND l_returnflag = 'N' THEN NULL"
        " ELSE concat(l_returnflag, '-', l_linenumber) END AS motivo",
    )
    paid = lines.filter("sheet = 'LICENCIA CON GOCE'")
    unpaid = lines.filter("sheet = 'LICENCIA SIN GOCE'")
    with_pay = grid(paid, 2, PAID_HEADER, ["dni", "'relleno'", "periodo", "'P'", "'M'", "'N'", "motivo"])
    without = grid(unpaid, 2, UNPAID_HEADER, ["dni", "periodo", "'P'", "'M'", "'N'", "motivo", "'obs'"])
    return with_pay.unionByName(without)


# ---- retirement exams, from orders -------------------------------------------------------------------

EXAM_HEADER = ("NOMBRE", "DNI", "FECHA DE CESE", "CAUSA DE SALIDA", "CARGO", "NOMBRE DE CC", None, "NOTA")


@stored("exams")
def exam_sheets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "concat('examenes ', date_format(o_orderdate, 'yyyy-MM'), '.xlsx') AS file", "'DATA' AS sheet",
        "o_orderkey + 4 AS row_idx",
        f"CASE WHEN {CUT_MONTH} AND o_orderkey % 5 = 2 THEN NULL ELSE concat('P', o_custkey, ' ') END AS nombre",
        "CASE WHEN o_orderkey % 2 = 0 THEN concat(o_orderkey, '.0') ELSE cast(o_orderkey AS string) END AS dni",
        """CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
           WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 2 THEN '#N/A' WHEN 3 THEN NULL ELSE 'pronto' END AS cese""",
        "o_orderstatus AS causa", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS cargo",
        "CASE o_orderkey % 4 WHEN 0 THEN '#N/D' WHEN 1 THEN NULL WHEN 2 THEN '4501.50' ELSE ' C1 ' END AS cc",
    )
    cells = ["nombre", "dni", "cese", "causa", "cargo", "cc", "'x'", "'y'"]
    return grid(rows, 3, EXAM_HEADER, cells)


# ---- the same rows for the checking engine -----------------------------------------------------------

SQL = {
    "turns": """
  SELECT 'conv_' || conv_id AS file, turn AS row_idx,
    CASE WHEN length(text) % 4 = 0 THEN ' ' WHEN length(text) % 7 = 0 THEN NULL ELSE role END AS clave,
    CASE WHEN length(text) % 5 = 0 THEN NULL ELSE text END AS texto
  FROM conversations""",
    "payroll_rows": """
  SELECT strftime(o_orderdate, '%Y-%m') AS ym, CASE WHEN year(o_orderdate) = 2001 THEN 1 ELSE month(o_orderdate) % 2 END AS impar,
    CASE WHEN year(o_orderdate) = 2001 THEN 'Planilla sin fecha.xlsx'
      WHEN strftime(o_orderdate, '%Y-%m') = '1996-02' THEN '~$Planilla 1996-02 Empleados.xlsx'
      WHEN strftime(o_orderdate, '%Y-%m') = '1996-03' THEN 'Consolidado 1996-03.xlsx'
      ELSE 'Planilla ' || strftime(o_orderdate, '%Y-%m') || ' Empleados.xlsx' END AS file,
    CASE WHEN strftime(o_orderdate, '%Y-%m') = '1997-05' THEN 'Hoja1' ELSE 'Planilla' END AS sheet,
    CASE WHEN o_orderkey % 89 = 3 THEN 'Total general de la planilla' WHEN o_orderkey % 83 = 2 THEN NULL
      ELSE CAST(o_orderkey AS VARCHAR) END AS n,
    CASE WHEN o_orderkey % 59 = 4 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS dni,
    ' NOM ' || o_custkey AS nombres,
    CASE WHEN o_orderkey % 71 = 0 THEN 'abc' ELSE o_custkey || '.5' END AS horas,
    CASE o_orderkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN ' M ' WHEN 3 THEN 'X' END AS sexo,
    CAST(o_custkey % 31 - 1 AS VARCHAR) AS dias,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS nacimiento,
    CASE WHEN o_orderkey % 7 = 0 THEN 's/f' WHEN o_orderkey % 7 = 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.000')
      ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS nacimiento_texto,
    CASE WHEN o_orderkey % 73 = 0 THEN '-' ELSE CAST(o_custkey * 2 AS VARCHAR) END AS neto,
    o_orderpriority AS concepto
  FROM orders""",
    "payroll_kept": """
  SELECT * FROM payroll_rows
  WHERE sheet = 'Planilla' AND regexp_matches(file, '\\d{4}-\\d{2}') AND NOT starts_with(file, '~$')
    AND NOT starts_with(file, 'Consolidado') AND n IS NOT NULL AND n <> 'Total general de la planilla' AND dni IS NOT NULL""",
    "payroll_silver": """
  SELECT ym AS PERIODO, substr(ym, 1, 4) AS "AÑO", CAST(substr(ym, 6, 2) AS INTEGER) AS MES, n AS "N°", dni AS "DNI/CEX",
    CASE WHEN impar = 1 THEN nombres END AS NOMBRES, CASE WHEN impar = 1 THEN horas END AS "HORAS EXTRAS 25%",
    sexo AS SEXO, CASE WHEN impar = 0 THEN dias END AS "DIAS GOCE HABER(D)",
    CASE WHEN impar = 0 THEN nacimiento_texto END AS "F. NACIMIENTO", CASE WHEN impar = 0 THEN neto END AS NETO,
    CASE WHEN impar = 0 THEN concepto END AS CONCEPTO, CASE WHEN impar = 0 THEN nacimiento END AS fecha
  FROM payroll_kept""",
    "master_rows": """
  SELECT 'bd_' || strftime(o_orderdate, '%Y-%m') || '.xlsx' AS file, o_orderkey + 11 AS row_idx,
    CASE WHEN strftime(o_orderdate, '%Y-%m') = '1995-03' AND o_orderkey % 5 = 2 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS doc,
    CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 'N' || o_custkey END AS nombre,
    CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') WHEN 1 THEN '31/02/2024'
      WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ingreso,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'TERMINO DE CONVENIO' WHEN o_orderpriority <> '2-HIGH' THEN o_orderpriority
      END AS modalidad
  FROM orders""",
    "master_silver": """
  SELECT m.* FROM master_rows m
  LEFT JOIN (SELECT file, MIN(row_idx) AS cut FROM master_rows WHERE doc = '' GROUP BY file) c ON m.file = c.file
  WHERE cut IS NULL OR row_idx < cut""",
    "control_rows": """
  SELECT o_orderkey // 500 AS file, o_orderkey % 500 + 5 + """ + CONTROL_GAP.format(div="//") + """ AS row_idx,
    CASE WHEN o_orderkey < 20 OR o_orderkey % 53 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS dni,
    o_orderkey, o_custkey, o_orderpriority,
    CASE WHEN o_orderkey % 5 < 3 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN o_orderkey % 5 = 3 THEN CAST(DATE '1899-12-30' + CAST(34700 + o_orderkey % 2000 AS INTEGER) AS VARCHAR) END
      AS ingreso,
    CAST(DATE '1899-12-30' + CAST(35000 + o_custkey % 1000 AS INTEGER) AS VARCHAR) AS renovacion
  FROM orders""",
    "control_kept": """
  SELECT k.* FROM control_rows k
  LEFT JOIN (SELECT file, MIN(row_idx) AS cut FROM (
      SELECT file, row_idx, lag(row_idx) OVER (PARTITION BY file ORDER BY row_idx) AS before
      FROM control_rows WHERE dni IS NOT NULL)
    WHERE row_idx - before > 1000 GROUP BY file) c ON k.file = c.file
  WHERE dni IS NOT NULL AND (cut IS NULL OR row_idx < cut)""",
    "income_rows": """
  SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m') <> '1995-03' OR o_orderkey < (
    SELECT coalesce(MIN(o_orderkey), 9223372036854775807) FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') = '1995-03' AND o_orderkey % 5 = 2)""",
    "income_employees": """
  SELECT year(o_orderdate) || '-' || lpad(mes, 2, '0') AS PERIODO, CAST(year(o_orderdate) AS VARCHAR) AS "AÑO", mes AS MES,
    CAST(o_custkey AS VARCHAR) AS DNI, 'D' || o_custkey AS "N° DOCUM.",
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "FECHA NACIMIENTO", 'F' AS SEXO, 'Lima' AS DEPARTAMENTO,
    NULL::VARCHAR AS PROVINCIA, '' AS DISTRITO, o_orderpriority AS CARGO, 'A' AS "ÁREA", 'L' AS "LUGAR DE TRABAJO",
    '2020-02-30 00:00:00' AS "FECHA INICIO", 'WC' AS "WC/BC", NULL::VARCHAR AS "Tiempo de contrato",
    CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE 'S' END AS SERVICIO, 'R' AS REGIMEN,
    CASE WHEN o_orderkey % 4 = 3 THEN 'P1' ELSE 'Staff' END AS PROYECTO,
    CASE WHEN o_orderkey % 4 = 3 THEN 'C9' END AS "CODIGO SAP"
  FROM (SELECT *, CASE WHEN o_orderkey % 31 = 0 THEN '13' WHEN o_orderkey % 37 = 0 THEN NULL
    ELSE CAST(month(o_orderdate) AS VARCHAR) END AS mes FROM income_rows)""",
    "leave_rows": """
  SELECT CASE WHEN l_linestatus = 'F' THEN 'CON_GOCE' ELSE 'SIN_GOCE' END AS tipo,
    CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS dni,
    CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE strftime(l_shipdate, '%Y-%m') END AS periodo,
    CASE WHEN l_linenumber IN (3, 4) AND l_returnflag = 'N' THEN NULL ELSE l_returnflag || '-' || l_linenumber END AS motivo
  FROM lineitem""",
    "exam_rows": """
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS file,
    CASE WHEN strftime(o_orderdate, '%Y-%m') = '1995-03' AND o_orderkey % 5 = 2 THEN NULL ELSE 'P' || o_custkey END AS nombre,
    CAST(o_orderkey AS VARCHAR) AS dni,
    CASE WHEN o_orderkey % 5 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS cese, o_orderstatus AS causa,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS cargo,
    CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '4501.5' ELSE 'C1' END AS cc
  FROM orders""",
}


def cte(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"
