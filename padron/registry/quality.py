"""Queries over profiles, duplicate keys, constraint reports and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.operators import aggregates, quality, rows
from padron.plans import employees
from padron.registry import frames
from padron.registry.common import Registry
from padron.registry.frames import cte, table
from padron.sources.specs import FieldSpec, TableSpec

query = Registry()


@query(
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS cantidad FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"""
)
def key_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


_NULLS = " UNION ALL ".join(
    f"""SELECT '{c}' AS columna, COUNT(*) - COUNT("{c}") AS nulos, COUNT(*) AS total FROM emp"""
    for c in (employees.KEY, employees.BORN, employees.HIRED, employees.ENDED, employees.MODALITY)
)


@query(cte("emp") + f", t AS ({_NULLS}) SELECT *, round(100.0 * nulos / total, 2) AS porcentaje FROM t")
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.null_profile(frames.emp(spark, folder))


@query(
    """SELECT 'l_quantity' AS columna, MIN(l_quantity) AS minimo, MAX(l_quantity) AS maximo,
  COUNT(*) FILTER (l_quantity < 5) AS bajo_minimo, COUNT(*) FILTER (l_quantity > 40) AS sobre_maximo FROM lineitem
UNION ALL SELECT 'l_linenumber', MIN(l_linenumber), MAX(l_linenumber), COUNT(*) FILTER (l_linenumber < 2), 0
FROM lineitem"""
)
def range_profile(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return aggregates.range_profile(lines, {"l_quantity": 5, "l_linenumber": 2}, {"l_quantity": 40})


@query(
    """WITH t AS (SELECT 'devuelto' AS indicador, COUNT(*) FILTER (l_returnflag = 'R') AS cantidad, COUNT(*) AS total
  FROM lineitem
UNION ALL SELECT 'abierto', COUNT(*) FILTER (l_linestatus = 'O'), COUNT(*) FROM lineitem
UNION ALL SELECT 'descuento', COUNT(*) FILTER (l_discount > 0.05), COUNT(*) FROM lineitem)
SELECT *, round(100.0 * cantidad / total, 2) AS porcentaje FROM t"""
)
def flag_profile(spark: SparkSession, folder: str) -> DataFrame:
    flagged = table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").alias("devuelto"),
        (F.col("l_linestatus") == "O").alias("abierto"),
        (F.col("l_discount") > 0.05).alias("descuento"),
    )
    return aggregates.flag_profile(flagged, flagged.columns)


@query(
    """WITH v AS (SELECT 'o_orderpriority' AS columna, o_orderpriority AS valor FROM orders
  WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F')
UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey NOT IN (1, 2)),
d AS (SELECT columna, valor, COUNT(*) AS n FROM v GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY columna ORDER BY valor) AS rn FROM d)
SELECT columna, CAST(SUM(n) AS BIGINT) AS cantidad, COUNT(*) AS distintos,
  string_agg(CASE WHEN rn <= 5 THEN valor END, ', ' ORDER BY valor) AS ejemplos FROM r GROUP BY 1"""
)
def distinct_invalid(spark: SparkSession, folder: str) -> DataFrame:
    allowed = {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": ["F"], "o_custkey": [1, 2]}
    return aggregates.invalid_values(table(spark, folder, "orders"), allowed)


@query("SELECT event_type, COUNT(*) AS cantidad FROM events GROUP BY 1")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.value_counts(table(spark, folder, "events"), "event_type")


@query(
    """SELECT event_type, COUNT(*) AS cantidad, round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS porcentaje
FROM events GROUP BY 1"""
)
def value_shares(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.shares(table(spark, folder, "events"), "event_type")


@query("SELECT DISTINCT user_id FROM events")
def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.distinct_values(table(spark, folder, "events"), "user_id")


@query("SELECT COUNT(*) AS filas, COUNT(DISTINCT l_orderkey) AS pedidos FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").agg(
        F.count(F.lit(1)).alias("filas"), F.count_distinct("l_orderkey").alias("pedidos")
    )


LINES = TableSpec(
    "lines",
    (
        FieldSpec("l_orderkey", "integer", False),
        FieldSpec("l_linenumber", "integer", False, minimum=2, maximum=6),
        FieldSpec("l_returnflag", allowed=("A", "R"), pattern="^[AR]$"),
        FieldSpec("l_quantity", "float", minimum=5),
        FieldSpec("l_comment", "string", False),
    ),
    primary_key=("l_orderkey", "l_linenumber"),
)

_LINE_FINDINGS = """SELECT 'l_comment' AS columna, 'columna' AS regla, 'error' AS severidad, 1::BIGINT AS cantidad,
  'missing' AS detalle
UNION ALL SELECT 'l_linenumber', 'minimo', 'aviso', COUNT(*), '2' FROM lineitem WHERE l_linenumber < 2
UNION ALL SELECT 'l_quantity', 'minimo', 'aviso', COUNT(*), '5' FROM lineitem WHERE l_quantity < 5
UNION ALL SELECT 'l_returnflag', 'valores', 'aviso', COUNT(*), 'N' FROM lineitem WHERE l_returnflag NOT IN ('A', 'R')
UNION ALL SELECT 'l_orderkey, l_linenumber', 'clave', 'error', COUNT(*), '' FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)"""


@query(_LINE_FINDINGS)
def constraint_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.constraint_findings(table(spark, folder, "lineitem"), LINES)


@query(
    _LINE_FINDINGS
    + """
UNION ALL SELECT 'l_linenumber', 'maximo', 'error', COUNT(*), '6' FROM lineitem WHERE l_linenumber > 6
UNION ALL SELECT 'l_returnflag', 'patron', 'error', COUNT(*), '^[AR]$' FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT 'descuento bajo impuesto', 'regla', 'error', COUNT(*), '' FROM lineitem WHERE l_discount > l_tax"""
)
def constraint_report_extras(spark: SparkSession, folder: str) -> DataFrame:
    """With the declared rules that are off by default, and a rule across columns."""
    crossed = {"descuento bajo impuesto": F.col("l_discount") <= F.col("l_tax")}
    return quality.constraint_findings(
        table(spark, folder, "lineitem"), LINES, extras=True, cross_rules=crossed
    )


@query(
    cte("raw")
    + """SELECT 'filas_entrada' AS medida, COUNT(*) AS valor, 100.0::DOUBLE AS porcentaje FROM raw
UNION ALL SELECT 'filas_salida', COUNT(numero), round(100.0 * COUNT(numero) / COUNT(*), 2) FROM raw
UNION ALL SELECT 'nulos: fecha', COUNT(*) - COUNT(fecha), round(100.0 * (COUNT(*) - COUNT(fecha)) / COUNT(*), 2)
  FROM raw WHERE numero IS NOT NULL
UNION ALL SELECT 'nulos: entero', COUNT(*) - COUNT(entero), round(100.0 * (COUNT(*) - COUNT(entero)) / COUNT(*), 2)
  FROM raw WHERE numero IS NOT NULL"""
)
def stage_report(spark: SparkSession, folder: str) -> DataFrame:
    before = frames.raw(spark, folder).select("id", "numero", "entero", "fecha")
    return quality.stage_report(before, rows.drop_null_key(before, "numero"))


@query(
    cte("emp")
    + """SELECT "Modalidad de Contrato" AS modalidad, COUNT(*) AS cantidad,
  round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS porcentaje FROM emp GROUP BY 1"""
)
def modality_shares(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.shares(frames.emp(spark, folder), employees.MODALITY).withColumnRenamed(
        employees.MODALITY, "modalidad"
    )
