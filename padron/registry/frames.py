"""Workforce-shaped frames derived row by row from the given tables, in Spark and as SQL text.

Each frame covers its whole source table. The SQL text defines the same frame for a checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2000-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cte(*names: str) -> str:
    """WITH clause for the named frames, in order."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"


# ---- employees, from orders --------------------------------------------------------------------


def emp(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey AS string) AS `NUMERO DE DOC`",
        "CASE WHEN o_custkey % 97 <> 0 THEN date_add(DATE'1928-01-01', cast(o_custkey * 17 % 3000 AS int)) END"
        " AS `FECHA DE NAC.`",
        "CASE WHEN o_orderkey % 101 <> 0 THEN cast(o_orderdate AS date) END AS `FECH_INGR.`",
        "CASE WHEN o_orderstatus = 'F' THEN date_add(cast(o_orderdate AS date), cast(o_orderkey % 2500 AS int)) END"
        " AS `Fecha de Termino`",
        """CASE WHEN o_orderkey % 211 = 7 THEN NULL
                WHEN o_orderpriority = '1-URGENT' THEN 'CONTRATO POR OBRA O SERVICIO ESPECIFICO'
                WHEN o_orderpriority = '2-HIGH' THEN 'CONTRATO POR INCREMENTO DE ACTIVIDAD'
                WHEN o_orderpriority = '5-LOW' THEN 'TERMINO DE CONVENIO'
                ELSE 'PLAZO INDETERMINADO' END AS `Modalidad de Contrato`""",
    )


def emp_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Some documents held by two rows, some unknown."""
    doc = F.expr(
        """CASE WHEN `NUMERO DE DOC` % 77 = 5 THEN NULL
                WHEN `NUMERO DE DOC` % 50 = 0 THEN cast(cast(`NUMERO DE DOC` AS bigint) + 1 AS string)
                ELSE `NUMERO DE DOC` END"""
    )
    return emp(spark, folder).withColumn("NUMERO DE DOC", doc)


# ---- payroll and leave, from orders and lineitem -----------------------------------------------------


def pay(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .selectExpr("cast(o_custkey AS string) AS `DNI/CEX`", "date_format(o_orderdate, 'yyyy-MM') AS PERIODO")
        .groupBy("`DNI/CEX`", "PERIODO")
        .agg(F.count(F.lit(1)).alias("total"))
    )


def leave(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "concat(l_returnflag, '-', l_linenumber) AS MOTIVO",
        "CASE WHEN l_linestatus = 'F' THEN 'CON_GOCE' ELSE 'SIN_GOCE' END AS TIPO_LICENCIA",
    )
    people = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "cast(o_custkey AS string) AS `DNI/CEX`", "date_format(o_orderdate, 'yyyy-MM') AS PERIODO"
    )
    return lines.join(people, lines.l_orderkey == people.o_orderkey).select(
        "`DNI/CEX`", "PERIODO", "MOTIVO", "TIPO_LICENCIA"
    )


# ---- catalogues and exams ---------------------------------------------------------------------------


def cc_old(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat(p_brand, '-', p_size) AS CC", "p_name AS `NOMBRE CC`", "p_type AS `CATEGORIA CC`",
        "concat('G', p_partkey % 13) AS GERENCIA", "p_partkey AS orden",
    )


def cc_new(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "concat('Brand#', s_suppkey % 30 + 1, '-', s_suppkey * 7 % 50 + 1) AS CC", "s_name AS `NOMBRE CC`",
        "CASE WHEN s_nationkey % 4 <> 0 THEN concat('N', s_nationkey) END AS `CATEGORIA CC`",
        "concat('H', s_suppkey % 5) AS GERENCIA", "s_suppkey AS orden",
    )


def exam_silver(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('P', o_custkey) AS NOMBRE", "cast(o_orderkey AS string) AS DNI",
        "CASE WHEN o_orderkey % 61 <> 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') ELSE 's/f' END"
        " AS `FECHA DE CESE`",
        "o_orderstatus AS `CAUSA DE SALIDA`",
        """CASE WHEN o_orderpriority = '5-LOW' THEN 'STUDENT INTERNAL'
                WHEN o_orderpriority = '3-MEDIUM' AND o_custkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS CARGO""",
        """CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 50 = 1 THEN NULL WHEN o_orderkey % 40 = 2 THEN 'ZZ'
                ELSE concat('Brand#', o_orderkey % 27 + 1, '-', o_custkey % 53 + 1) END AS `NOMBRE DE CC`""",
    )


# ---- interns -------------------------------------------------------------------------------------


def interns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey AS string) AS DNI",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'PRACTICANTE PREPROFESIONAL'"
        " WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'PRACTICANTE PROFESIONAL' END AS CONDICION",
        "CASE WHEN o_orderkey % 103 <> 0 THEN cast(o_orderdate AS date) END AS `FECHA ING`",
        "CASE WHEN o_orderstatus <> 'P' THEN date_add(cast(o_orderdate AS date), cast(o_orderkey % 1200 - 20 AS int)) END"
        " AS `F. RENOVACION`",
        "concat('S', o_custkey % 5) AS SEDE", "concat('U', o_custkey % 11) AS UNIVERSIDAD",
        "concat('J', o_custkey % 17) AS `JEFE INMEDIATO`", "concat('G', o_custkey % 7) AS GERENCIA",
    )


# ---- dirty text, from orders ----------------------------------------------------------------------


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id",
        """CASE o_orderkey % 8 WHEN 0 THEN '12.0' WHEN 1 THEN ' 7 ' WHEN 2 THEN '' WHEN 3 THEN NULL
                WHEN 4 THEN '#N/D' WHEN 5 THEN concat(cast(o_custkey AS string), '.5')
                WHEN 6 THEN concat('-', o_custkey) ELSE cast(o_custkey AS string) END AS numero""",
        "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE cast(o_custkey AS string) END AS entero",
        """CASE o_orderkey % 9 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
                WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy') WHEN 2 THEN date_format(o_orderdate, 'd-M-yyyy')
                WHEN 3 THEN date_format(o_orderdate, 'yyyy/MM/dd') WHEN 4 THEN date_format(o_orderdate, 'dd.MM.yyyy')
                WHEN 5 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') WHEN 6 THEN '01/02/24'
                WHEN 7 THEN '31/02/2024' ELSE NULL END AS fecha""",
        """CASE o_orderkey % 6 WHEN 0 THEN cast(30000 + o_custkey AS string)
                WHEN 1 THEN concat(cast(40000 + o_custkey AS string), '.75') WHEN 2 THEN '45292'
                WHEN 3 THEN 'abc' WHEN 4 THEN NULL ELSE '99999999' END AS serie""",
        """CASE o_orderkey % 7 WHEN 0 THEN '#N/D' WHEN 1 THEN ' #N/A x' WHEN 2 THEN 'ERROR 5' WHEN 3 THEN 'un Error'
                WHEN 4 THEN NULL WHEN 5 THEN '#REF!' ELSE concat('SAP', o_custkey) END AS codigo""",
        """CASE o_orderkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN NULL WHEN 4 THEN '00'
                ELSE concat(' P', o_custkey, ' ') END AS proyecto""",
        """CASE o_orderkey % 6 WHEN 0 THEN 'None' WHEN 1 THEN 'nan' WHEN 2 THEN 'NaT' WHEN 3 THEN NULL
                WHEN 4 THEN 'none' ELSE o_orderpriority END AS palabra""",
        "concat(repeat(' ', cast(o_orderkey % 3 AS int)), char(9), o_orderpriority, char(10)) AS holgado",
        "o_totalprice AS importe",
    )


_MODALITY = """CASE WHEN o_orderkey % 211 = 7 THEN NULL
    WHEN o_orderpriority = '1-URGENT' THEN 'CONTRATO POR OBRA O SERVICIO ESPECIFICO'
    WHEN o_orderpriority = '2-HIGH' THEN 'CONTRATO POR INCREMENTO DE ACTIVIDAD'
    WHEN o_orderpriority = '5-LOW' THEN 'TERMINO DE CONVENIO'
    ELSE 'PLAZO INDETERMINADO' END"""

SQL = {
    "emp": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS "NUMERO DE DOC",
    CASE WHEN o_custkey % 97 <> 0 THEN DATE '1928-01-01' + CAST(o_custkey * 17 % 3000 AS INTEGER) END AS "FECHA DE NAC.",
    CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_orderdate AS DATE) END AS "FECH_INGR.",
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 2500 AS INTEGER) END
      AS "Fecha de Termino",
    {_MODALITY} AS "Modalidad de Contrato"
  FROM orders""",
    "emp_repeated": """
  SELECT CASE WHEN CAST("NUMERO DE DOC" AS BIGINT) % 77 = 5 THEN NULL
      WHEN CAST("NUMERO DE DOC" AS BIGINT) % 50 = 0 THEN CAST(CAST("NUMERO DE DOC" AS BIGINT) + 1 AS VARCHAR)
      ELSE "NUMERO DE DOC" END AS "NUMERO DE DOC",
    "FECHA DE NAC.", "FECH_INGR.", "Fecha de Termino", "Modalidad de Contrato"
  FROM emp""",
    "pay": """
  SELECT CAST(o_custkey AS VARCHAR) AS "DNI/CEX", strftime(o_orderdate, '%Y-%m') AS PERIODO, COUNT(*) AS total
  FROM orders GROUP BY 1, 2""",
    "leave": """
  SELECT CAST(o_custkey AS VARCHAR) AS "DNI/CEX", strftime(o_orderdate, '%Y-%m') AS PERIODO,
    l_returnflag || '-' || l_linenumber AS MOTIVO,
    CASE WHEN l_linestatus = 'F' THEN 'CON_GOCE' ELSE 'SIN_GOCE' END AS TIPO_LICENCIA
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cc_old": """
  SELECT p_brand || '-' || p_size AS CC, p_name AS "NOMBRE CC", p_type AS "CATEGORIA CC",
    'G' || (p_partkey % 13) AS GERENCIA, p_partkey AS orden
  FROM part""",
    "cc_new": """
  SELECT 'Brand#' || (s_suppkey % 30 + 1) || '-' || (s_suppkey * 7 % 50 + 1) AS CC, s_name AS "NOMBRE CC",
    CASE WHEN s_nationkey % 4 <> 0 THEN 'N' || s_nationkey END AS "CATEGORIA CC",
    'H' || (s_suppkey % 5) AS GERENCIA, s_suppkey AS orden
  FROM supplier""",
    "cc_unified": """
  SELECT CC, "NOMBRE CC", "CATEGORIA CC", GERENCIA FROM (
    SELECT *, row_number() OVER (PARTITION BY CC ORDER BY fuente DESC, orden) AS rn
    FROM (SELECT *, 2 AS fuente FROM cc_new UNION ALL SELECT *, 1 AS fuente FROM cc_old)) WHERE rn = 1""",
    "exam_silver": """
  SELECT 'P' || o_custkey AS NOMBRE, CAST(o_orderkey AS VARCHAR) AS DNI,
    CASE WHEN o_orderkey % 61 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE 's/f' END AS "FECHA DE CESE",
    o_orderstatus AS "CAUSA DE SALIDA",
    CASE WHEN o_orderpriority = '5-LOW' THEN 'STUDENT INTERNAL'
      WHEN o_orderpriority = '3-MEDIUM' AND o_custkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS CARGO,
    CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 50 = 1 THEN NULL WHEN o_orderkey % 40 = 2 THEN 'ZZ'
      ELSE 'Brand#' || (o_orderkey % 27 + 1) || '-' || (o_custkey % 53 + 1) END AS "NOMBRE DE CC"
  FROM orders""",
    "exam": """
  SELECT NOMBRE, DNI, fecha AS "FECHA DE CESE", "CAUSA DE SALIDA", CARGO, "NOMBRE DE CC",
    CAST(year(fecha) AS INTEGER) AS "AÑO", CAST(month(fecha) AS INTEGER) AS MES,
    ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'
    ][month(fecha)] AS NOMBRE_MES
  FROM (SELECT *, CAST(try_strptime("FECHA DE CESE", '%Y-%m-%d %H:%M:%S') AS DATE) AS fecha FROM exam_silver)
  WHERE CARGO <> 'STUDENT INTERNAL'""",
    "exam_enriched": """
  SELECT NOMBRE, DNI, CAST("FECHA DE CESE" AS VARCHAR) AS "FECHA DE CESE", "CAUSA DE SALIDA", CARGO,
    "NOMBRE DE CC" AS codigo_cc_original, "AÑO", MES, NOMBRE_MES, c.CC AS codigo_cc,
    c."NOMBRE CC" AS nombre_cc_completo, c."CATEGORIA CC" AS categoria_cc, c.GERENCIA AS gerencia,
    CASE WHEN "NOMBRE DE CC" = '' THEN 'SIN_CODIGO' WHEN c.CC IS NULL THEN 'CODIGO_NO_ENCONTRADO' ELSE 'OK' END
      AS status_match
  FROM exam e LEFT JOIN cc_unified c ON e."NOMBRE DE CC" = c.CC""",
    "interns": """
  SELECT CAST(o_orderkey AS VARCHAR) AS DNI,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'PRACTICANTE PREPROFESIONAL'
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'PRACTICANTE PROFESIONAL' END AS CONDICION,
    CASE WHEN o_orderkey % 103 <> 0 THEN CAST(o_orderdate AS DATE) END AS "FECHA ING",
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1200 - 20 AS INTEGER) END
      AS "F. RENOVACION",
    'S' || (o_custkey % 5) AS SEDE, 'U' || (o_custkey % 11) AS UNIVERSIDAD,
    'J' || (o_custkey % 17) AS "JEFE INMEDIATO", 'G' || (o_custkey % 7) AS GERENCIA
  FROM orders""",
    "interns_days": """
  SELECT *, "F. RENOVACION" - "FECHA ING" AS dias FROM interns""",
    "interns_parts": """
  SELECT DNI, CONDICION, "FECHA ING", "F. RENOVACION", SEDE, UNIVERSIDAD, "JEFE INMEDIATO", GERENCIA,
    CAST(dias AS INTEGER) AS dias_servicio, CAST(FLOOR(dias / 365.25) AS INTEGER) AS anios_servicio,
    CAST(FLOOR((dias % 365.25) / 30.44) AS INTEGER) AS meses_servicio
  FROM interns_days""",
    # The day ranges as a table of conditions; a flag is whether a row lies in its range.
    "interns_flags": """
  WITH ranges(flag, low, high) AS (VALUES ('near1', 335, 364), ('full1', 365, 999999999), ('near2', 640, 729)),
  inside AS (
    SELECT DNI, max(flag) FILTER (flag = 'near1') AS near1, max(flag) FILTER (flag = 'full1') AS full1,
      max(flag) FILTER (flag = 'near2') AS near2
    FROM interns_parts JOIN ranges ON dias_servicio >= low AND dias_servicio <= high
    WHERE CONDICION = 'PRACTICANTE PROFESIONAL' GROUP BY DNI)
  SELECT p.*, CASE WHEN p.dias_servicio IS NOT NULL THEN if(near1 IS NULL, 'NO', 'SI') END AS por_cumplir_1, CASE WHEN p.dias_servicio IS NOT NULL THEN if(full1 IS NULL, 'NO', 'SI') END AS cumplio_1,
    CASE WHEN p.dias_servicio IS NOT NULL THEN if(near2 IS NULL, 'NO', 'SI') END AS por_cumplir_2
  FROM interns_parts p LEFT JOIN inside USING (DNI)""",
    # The phrase from its parts: years and months, each with number and unit, joined by 'y' where both are there.
    "interns_phrase": """
  SELECT *, CASE WHEN anios_servicio IS NOT NULL THEN coalesce(
      list_extract(list_filter(['1 año (En límite)', '2 años (Límite Máximo)'],
        lambda m, i: [por_cumplir_1, por_cumplir_2][i] = 'SI'), 1),
      array_to_string(list_filter([
        nullif(anios_servicio || CASE anios_servicio WHEN 1 THEN ' año' ELSE ' años' END, '0 años'),
        CASE WHEN meses_servicio <> 0 OR anios_servicio = 0 THEN meses_servicio || ' meses' END],
        lambda part: part IS NOT NULL), ' y ')) END AS tiempo_servicio
  FROM interns_flags""",
    "raw": """
  SELECT o_orderkey AS id,
    CASE o_orderkey % 8 WHEN 0 THEN '12.0' WHEN 1 THEN ' 7 ' WHEN 2 THEN '' WHEN 3 THEN NULL
      WHEN 4 THEN '#N/D' WHEN 5 THEN o_custkey || '.5' WHEN 6 THEN '-' || o_custkey
      ELSE CAST(o_custkey AS VARCHAR) END AS numero,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS entero,
    CASE o_orderkey % 9 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 2 THEN strftime(o_orderdate, '%-d-%-m-%Y') WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d')
      WHEN 4 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      WHEN 6 THEN '01/02/24' WHEN 7 THEN '31/02/2024' ELSE NULL END AS fecha,
    CASE o_orderkey % 6 WHEN 0 THEN CAST(30000 + o_custkey AS VARCHAR) WHEN 1 THEN (40000 + o_custkey) || '.75'
      WHEN 2 THEN '45292' WHEN 3 THEN 'abc' WHEN 4 THEN NULL ELSE '99999999' END AS serie,
    CASE o_orderkey % 7 WHEN 0 THEN '#N/D' WHEN 1 THEN ' #N/A x' WHEN 2 THEN 'ERROR 5' WHEN 3 THEN 'un Error'
      WHEN 4 THEN NULL WHEN 5 THEN '#REF!' ELSE 'SAP' || o_custkey END AS codigo,
    CASE o_orderkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN NULL WHEN 4 THEN '00'
      ELSE ' P' || o_custkey || ' ' END AS proyecto,
    CASE o_orderkey % 6 WHEN 0 THEN 'None' WHEN 1 THEN 'nan' WHEN 2 THEN 'NaT' WHEN 3 THEN NULL WHEN 4 THEN 'none'
      ELSE o_orderpriority END AS palabra,
    repeat(' ', CAST(o_orderkey % 3 AS INTEGER)) || chr(9) || o_orderpriority || chr(10) AS holgado,
    o_totalprice AS importe
  FROM orders""",
}
