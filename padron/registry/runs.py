"""Queries over published tables, rules as data, contracts, and whole runs read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions import flag_rules
from padron.operators import quality
from padron.plans import employees, exams, internships, leaves, payroll
from padron.registry import frames
from padron.registry import sheet_frames as sheets
from padron.registry.common import Registry
from padron.registry.enrichment import _DAYS
from padron.registry.frames import AS_OF, table
from padron.registry.jobs import OWN_OUTPUTS
from padron.registry.sheet_frames import cte
from padron.session import col, shared_folder
from padron.sources import sinks, tables
from padron.sources.contracts import SheetContract, SourceContract
from padron.sources.queries import run_sql
from padron.sources.specs import FieldSpec, TableSpec, spec_from_json

query = Registry()


def _count(df: DataFrame, name: str, label: str = "tabla") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias(label), "filas")


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- published tables --------------------------------------------------------------------------


@query(
    """SELECT etapa, p_partkey, p_name, p_size + 1 AS p_size FROM part, (VALUES ('interrumpida'), ('recuperada')) AS v(etapa)"""
)
def publication_interrupted(spark: SparkSession, folder: str) -> DataFrame:
    """A run ends after naming its rows and before moving them: readers have them all the same, and so does recovery."""
    path, seen = shared_folder(spark, "published"), shared_folder(spark, "seen")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    sinks.write_current(parts, path)
    staged = sinks.stage(parts.withColumn("p_size", F.col("p_size") + 1), path)
    place = tables.Files(spark, path).place(staged.folder)
    tables.commit(spark, path, [place], staged.schema, moving=staged.folder)
    during = sinks.write_current(tables.read(spark, path), seen)
    tables.recover(spark, path)
    after = spark.read.parquet(path)
    return during.withColumn("etapa", F.lit("interrumpida")).unionByName(after.withColumn("etapa", F.lit("recuperada")))


@query(
    """SELECT copia, part.* FROM part, (VALUES ('actual'), ('historico')) AS v(copia)"""
)
def published_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Both copies of a versioned output, read by their manifests."""
    paths = sinks.write_versioned(table(spark, folder, "part"), shared_folder(spark, "copies"), "part")
    return _together([tables.read(spark, p).withColumn("copia", F.lit(c)) for c, p in paths.items()])


@query(
    frames.cte("cc_old", "cc_new", "cc_unified", "exam_silver", "exam", "exam_enriched")
    + """, o AS (SELECT DNI, row_number() OVER (ORDER BY NOMBRE NULLS LAST, DNI NULLS LAST, "FECHA DE CESE" NULLS LAST,
  codigo_cc_original NULLS LAST) AS n, COUNT(*) OVER () AS filas FROM exam_enriched)
SELECT copia, filas, max(DNI) FILTER (n = 1) AS primero, max(DNI) FILTER (n = filas) AS ultimo
FROM o, (VALUES ('actual'), ('historico')) AS v(copia) GROUP BY copia, filas"""
)
def stored_order(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, first row of the first file and last row of the last one, of both copies; their files are in order."""
    typed, _ = exams.gold(frames.exam_silver(spark, folder))
    current, older = frames.cc_new(spark, folder), frames.cc_old(spark, folder)
    enriched = exams.enrich(typed, exams.unified_catalogue(current, older, ("orden",)))
    paths = sinks.write_versioned(enriched, shared_folder(spark, "ordered"), "exams", order=exams.order_of(enriched))
    place, count = F.struct("_metadata.file_name", "_metadata.row_index"), F.count(F.lit(1)).alias("filas")
    ends = []
    for copy, path in paths.items():
        sinks.check_order(spark, path, exams.order_of(enriched))
        found = spark.read.parquet(path).agg(count, F.min_by("DNI", place).alias("primero"), F.max_by("DNI", place).alias("ultimo"))
        ends.append(found.select(F.lit(copy).alias("copia"), "filas", "primero", "ultimo"))
    return _together(ends)


@query(
    """SELECT rama, copia, COUNT(*) AS filas, CAST(SUM(o_orderkey) AS BIGINT) AS claves
FROM (SELECT 'cerrados' AS rama, o_orderkey FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'urgentes', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'),
  (VALUES ('actual'), ('historico')) AS v(copia) GROUP BY rama, copia"""
)
def branches_written_once(spark: SparkSession, folder: str) -> DataFrame:
    """Branches that overlap and one without rows, from one pass; the empty one is not published."""
    branches = {
        "cerrados": F.col("o_orderstatus") == "F",
        "urgentes": F.col("o_orderpriority") == "1-URGENT",
        "vacia": F.col("o_orderkey").isNull(),
    }
    paths = sinks.write_branches(table(spark, folder, "orders"), branches, shared_folder(spark, "branches"))
    sums = [F.count(F.lit(1)).alias("filas"), F.sum("o_orderkey").alias("claves")]
    return _together(
        [tables.read(spark, path).agg(*sums).select(F.lit(name).alias("rama"), F.lit(copy).alias("copia"), "filas", "claves")
         for name, copies in paths.items() for copy, path in copies.items()]
    )


@query(
    """SELECT 'filas' AS medida, COUNT(*) AS valor FROM orders
UNION ALL SELECT 'sin cierre', COUNT(*) FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'total', CAST(SUM(o_custkey) AS BIGINT) FROM orders"""
)
def observed_while_writing(spark: SparkSession, folder: str) -> DataFrame:
    """Counts taken up by the write itself; no pass over the stored rows follows."""
    path = shared_folder(spark, "observed")
    measures = {"sin cierre": F.count_if(F.col("o_orderstatus") != "F"), "total": F.sum("o_custkey")}
    sinks.write_current(table(spark, folder, "orders"), path, observe=measures)
    return spark.createDataFrame(list(tables.metrics(spark, path).items()), "medida string, valor bigint")


# ---- files that cannot be used ------------------------------------------------------------------

_BAD_MONTHS = f"('{sheets.HEADLESS}', '{sheets.KEYLESS}')"


@query(
    cte("payroll_rows", "payroll_kept", "payroll_silver")
    + f"""SELECT PERIODO AS clave, 'filas' AS detalle, COUNT(*) AS cantidad FROM payroll_silver
WHERE PERIODO NOT IN {_BAD_MONTHS} GROUP BY PERIODO
UNION ALL SELECT file, CASE WHEN NOT regexp_matches(file, '\\d{{4}}-\\d{{2}}') THEN 'sin periodo'
  WHEN sheet <> 'Planilla' THEN 'sin hoja Planilla' WHEN ym = '{sheets.HEADLESS}' THEN 'sin cabecera'
  ELSE 'sin columna clave' END, 1
FROM (SELECT DISTINCT file, sheet, CASE WHEN ym IN {_BAD_MONTHS} THEN ym END AS ym FROM payroll_rows
  WHERE NOT starts_with(file, '~$') AND NOT starts_with(file, 'Consolidado'))
WHERE NOT regexp_matches(file, '\\d{{4}}-\\d{{2}}') OR sheet <> 'Planilla' OR ym IS NOT NULL"""
)
def payroll_with_bad_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per period of the good files, and every other file with its reason."""
    silver, rejected = payroll.consolidate(sheets.damaged_payroll_sheets(spark, folder), OWN_OUTPUTS)
    rows = silver.groupBy(F.col("PERIODO").alias("clave")).agg(F.count(F.lit(1)).alias("cantidad"))
    one = F.lit(1).cast("bigint").alias("cantidad")
    return rows.select("clave", F.lit("filas").alias("detalle"), "cantidad").unionByName(
        rejected.select(F.col("file").alias("clave"), F.col("motivo").alias("detalle"), one)
    )


# ---- rules as data -----------------------------------------------------------------------------


@query(
    """SELECT 'cese posterior al ingreso' AS columna, 'error' AS severidad, COUNT(*) AS cantidad FROM orders WHERE o_orderkey % 4 IN (2, 3)
UNION ALL SELECT 'motivo solo con cese', 'error', COUNT(*) FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 4 = 0"""
)
def payroll_row_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What a payroll run reports on its rules over several columns."""
    paths = payroll.run(sheets.leaver_sheets(spark, folder), shared_folder(spark, "leavers-run"))
    return tables.read(spark, paths["hallazgos"]).filter("regla = 'fila'").select("columna", "severidad", "cantidad")


@query(
    """SELECT 'neto cuadra' AS columna, 'aviso' AS severidad, COUNT(*) AS cantidad FROM orders
WHERE o_orderkey % 19 <> 0 AND (o_orderkey % 31 = 0 OR o_orderkey % 29 = 0)
UNION ALL SELECT 'dias trabajados en rango', 'error', COUNT(*) FROM orders WHERE o_orderkey % 35 > 31
UNION ALL SELECT 'ingreso anterior al periodo', 'error', COUNT(*) FROM orders WHERE o_orderkey % 13 = 0 AND o_orderkey % 17 <> 0
UNION ALL SELECT 'neto no negativo', 'aviso', COUNT(*) FROM orders WHERE o_orderkey % 31 = 0"""
)
def mining_row_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What a mining run reports on its rules over several columns."""
    paths = payroll.run(sheets.mining_sheets(spark, folder), shared_folder(spark, "mining-run"), mining=True)
    return tables.read(spark, paths["hallazgos"]).filter("regla = 'fila'").select("columna", "severidad", "cantidad")


@query(
    """SELECT strftime(o_orderdate, '%Y-%m') AS PERIODO, CAST(o_orderkey AS VARCHAR) AS "DNI/CEX", 'CC' || (o_custkey % 7) AS "CENTRO DE COSTOS",
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN strftime(last_day(CAST(o_orderdate AS DATE)) + 1, '%Y-%m-%d')
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "FECHA DE INGRESO",
  CAST(o_orderkey % 35 AS BIGINT) AS "DIAS TRABAJADOS", CAST(o_custkey + 1000 AS DOUBLE) AS "TOTAL INGRESOS",
  CAST(CASE WHEN o_orderkey % 31 = 0 THEN -5 ELSE CAST(o_custkey + 1000 - o_custkey % 100 + CASE WHEN o_orderkey % 29 = 0 THEN 2
    WHEN o_orderkey % 5 = 0 THEN 0.01 ELSE 0 END AS DECIMAL(14, 2)) END AS DOUBLE) AS NETO, 26::BIGINT AS columnas
FROM orders"""
)
def mining_run_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Mining gold with all of its own columns there and typed."""
    typed, _ = payroll.mining_gold(payroll.consolidate(sheets.mining_sheets(spark, folder))[0])
    wanted = ["PERIODO", "DNI/CEX", "CENTRO DE COSTOS", "FECHA DE INGRESO", "DIAS TRABAJADOS", "TOTAL INGRESOS", "NETO"]
    counted = F.lit(len([c for c in typed.columns if c != "NOMBRE_MES"])).cast("bigint").alias("columnas")
    return sinks.review_frame(typed.select(*[col(c) for c in wanted], counted))


_RULED = {
    "schema": {"o_orderkey": {"type": "integer"}, "o_orderdate": {"type": "date"}, "o_totalprice": {"type": "float"}},
    "constraints": {
        "unique_keys": [["o_custkey", "o_orderstatus", "o_orderpriority"], ["o_orderkey"]],
        "row_rules": [
            {"name": "cerrados son caros", "test": {"if": {"compare": ["o_orderstatus", "=", {"value": "F"}]},
                                                    "then": {"compare": ["o_totalprice", ">=", 100000]}}},
            {"name": "clave par o cliente menor", "severity": "aviso",
             "test": {"any": [{"compare": ["o_custkey", "<", "o_orderkey"]}, {"not": {"set": "o_clerk"}}]}},
        ],
    },
}


@query(
    """SELECT 'cerrados son caros' AS columna, 'fila' AS regla, 'error' AS severidad, COUNT(*) AS cantidad FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice < 100000
UNION ALL SELECT 'clave par o cliente menor', 'fila', 'aviso', COUNT(*) FROM orders WHERE o_custkey >= o_orderkey HAVING COUNT(*) > 0
UNION ALL SELECT 'o_custkey, o_orderstatus, o_orderpriority', 'unica', 'error', COUNT(*) FROM (
  SELECT 1 FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority HAVING COUNT(*) > 1)"""
)
def rules_from_a_document(spark: SparkSession, folder: str) -> DataFrame:
    """Unique keys and rules over several columns, all read from a document."""
    orders = table(spark, folder, "orders").withColumn("o_clerk", F.lit("c"))
    found = quality.constraint_findings(orders, spec_from_json(_RULED, "orders"))
    return found.select("columna", "regla", "severidad", "cantidad")


#: Other thresholds than the usual ones, an upper end, one rule that is off, one past its time, and an excluded contract.
_FLAG_RULES = {
    "reglas_edad": {"edad_60": {"edad_objetivo": 60, "alertas": {"cumple_este_año": {"columna_resultado": "cumple_60"},
                                                                 "cumple_proximo_año": {"columna_resultado": "cumplira_60"}}}},
    "reglas_contrato": [
        {"modalidad": "CONTRATO POR OBRA O SERVICIO ESPECIFICO", "alerta_desde_años": 1.5, "alerta_hasta_años": 4.0, "columna_resultado": "alerta"},
        {"modalidad": "CONTRATO POR INCREMENTO DE ACTIVIDAD", "alerta_desde_meses": 30, "columna_resultado": "alerta"},
        {"modalidad": "PLAZO INDETERMINADO", "alerta_desde_años": 0, "columna_resultado": "alerta"},
        {"modalidad": "PLAZO INDETERMINADO", "alerta_desde_años": 0, "columna_resultado": "apagada", "activo": False},
        {"modalidad": "TERMINO DE CONVENIO", "alerta_desde_años": 0, "columna_resultado": "caducada", "valido_hasta": "1999-12-31"},
    ],
    "contratos_excluidos": [{"modalidad": "PLAZO INDETERMINADO", "aplica_alertas_edad": False, "aplica_alertas_contrato": False}],
}


@query(
    frames.cte("emp")
    + f"""SELECT "NUMERO DE DOC" AS doc,
  CASE WHEN m = 'PLAZO INDETERMINADO' THEN false ELSE year("FECHA DE NAC.") = 1940 END AS cumple_60,
  CASE WHEN m = 'PLAZO INDETERMINADO' THEN false ELSE year("FECHA DE NAC.") = 1941 END AS cumplira_60,
  CASE WHEN m = 'PLAZO INDETERMINADO' THEN false ELSE (m = 'CONTRATO POR OBRA O SERVICIO ESPECIFICO' AND y >= 1.5 AND y < 4.0)
    OR (m = 'CONTRATO POR INCREMENTO DE ACTIVIDAD' AND y >= 2.5) OR (m = 'PLAZO INDETERMINADO' AND y >= 0) END AS alerta,
  CASE WHEN m = 'PLAZO INDETERMINADO' THEN false ELSE false END AS caducada
FROM (SELECT *, "Modalidad de Contrato" AS m, {_DAYS} / 365.25 AS y FROM emp)"""
)
def flag_rules_as_data(spark: SparkSession, folder: str) -> DataFrame:
    """Employee flags by rules from a document, none of which is the usual one."""
    rules = flag_rules.rules_from_json(_FLAG_RULES)
    flagged = employees.flags(frames.emp(spark, folder), AS_OF, rules=rules)
    return flagged.select(col(employees.KEY).alias("doc"), *rules.columns)


@query(
    """SELECT 'o_orderstatus' AS columna, 'valores' AS regla, o_orderstatus AS valor, COUNT(*) AS filas,
  MIN(CAST(o_orderkey AS VARCHAR)) AS primero FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus
UNION ALL SELECT 'o_custkey', 'minimo', CAST(o_custkey AS VARCHAR), COUNT(*), MIN(CAST(o_orderkey AS VARCHAR))
FROM orders WHERE o_custkey < 100 GROUP BY o_custkey
UNION ALL SELECT 'fecha', 'patron', strftime(o_orderdate, '%Y-%m-%d'), COUNT(*), MIN(CAST(o_orderkey AS VARCHAR))
FROM orders WHERE day(o_orderdate) < 20 GROUP BY 3"""
)
def every_bad_value(spark: SparkSession, folder: str) -> DataFrame:
    """All distinct values that break a rule, with their rows and the first place."""
    spec = TableSpec(
        "orders",
        (FieldSpec("o_orderstatus", allowed=("F",)), FieldSpec("o_custkey", "integer", minimum=100), FieldSpec("fecha", pattern="-[23][0-9]$")),
    )
    orders = table(spark, folder, "orders").withColumn("fecha", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return quality.bad_values(orders, spec, ["o_orderkey"], extras=True)


# ---- contracts and stored SQL --------------------------------------------------------------------

_TOGETHER = (
    SourceContract("uno", "Uno", (SheetContract("Practicantes", 4, 2, ("DNI", "NO ESTA")),)),
    SourceContract("dos", "Dos", (SheetContract("Practicantes", 4, 1, ("DNI",)),), ("Practicantes", "Resumen")),
    SourceContract("tres", "Tres", (), (), ("Otra",), True, (".xlsx",), "^control_1"),
)


@query(
    cte("control_rows")
    + """, f AS (SELECT DISTINCT 'control_' || file || '.xlsx' AS file FROM control_rows)
SELECT file, 'Practicantes' AS sheet, 'missing_columns' AS rule, 'NO ESTA' AS detail, 'uno' AS contract FROM f
UNION ALL SELECT file, 'Practicantes', 'shifted_header', '4:1', 'dos' FROM f
UNION ALL SELECT file, 'Resumen', 'missing_sheet', 'Resumen', 'dos' FROM f
UNION ALL SELECT file, 'Practicantes', 'unexpected_sheet', 'Practicantes', 'tres' FROM f
UNION ALL SELECT file, NULL, 'file_name', '^control_1', 'tres' FROM f WHERE NOT starts_with(file, 'control_1')"""
)
def contracts_together(spark: SparkSession, folder: str) -> DataFrame:
    """All breaches of three contracts from one pass over files, sheets and header rows."""
    return quality.check_contracts(sheets.control_sheets(spark, folder), _TOGETHER)


@query(
    """SELECT 'clientes' AS origen, COUNT(*) AS filas, CAST(SUM(c_custkey) AS BIGINT) AS suma FROM customer
UNION ALL SELECT 'pedidos', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders"""
)
def sql_names_apart(spark: SparkSession, folder: str) -> DataFrame:
    """Two stored queries that call different tables by one name; each sees its own rows when they run together."""
    text = "SELECT :origen AS origen, COUNT(*) AS filas, SUM(clave) AS suma FROM datos"
    customers = table(spark, folder, "customer").select(F.col("c_custkey").cast("bigint").alias("clave"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").cast("bigint").alias("clave"))
    one = run_sql(spark, text, {"datos": customers}, {"origen": "clientes"})
    return one.unionByName(run_sql(spark, text, {"datos": orders}, {"origen": "pedidos"}))


# ---- whole runs --------------------------------------------------------------------------------

_MASTER_GOLD = """empleados AS (SELECT * FROM master_silver WHERE modalidad IS NOT NULL AND NOT contains(modalidad, 'TERMINO DE CONVENIO')),
practicantes AS (SELECT * FROM master_silver WHERE contains(modalidad, 'TERMINO DE CONVENIO'))"""
# Columns the master sheets lack, which the flags need.
_LACKING = ("FECHA DE NAC.", "Fecha de Termino")


def _whole_master(spark: SparkSession, folder: str) -> DataFrame:
    """The master sheets with two more columns, which hold nothing."""
    more = F.array(*[F.lit(c) for c in _LACKING])
    # The header ends at its fourth cell; what lies beyond is left out.
    head = F.concat(F.slice("cells", 1, 4), more)
    line = F.concat(F.slice("cells", 1, 4), F.array(F.lit(None).cast("string"), F.lit(None).cast("string")))
    return sheets.master_sheets(spark, folder).withColumn("cells", F.when(F.col("row_idx") == 10, head).otherwise(line))


@query(
    cte("master_rows", "master_silver").rstrip()
    + ", " + _MASTER_GOLD
    + """SELECT 'silver' AS tabla, COUNT(*) AS filas FROM master_silver
UNION ALL SELECT t, COUNT(*) FROM empleados, (VALUES ('bd_empleados_gold.actual'), ('bd_empleados_gold.historico'),
  ('flags.actual'), ('flags.historico'), ('resumen')) AS v(t) GROUP BY t
UNION ALL SELECT t, COUNT(*) FROM practicantes, (VALUES ('bd_practicantes_gold.actual'), ('bd_practicantes_gold.historico')) AS v(t)
GROUP BY t"""
)
def employee_run_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table an employee run stores, and the total its summary tells."""
    paths = employees.run(_whole_master(spark, folder), shared_folder(spark, "employee-run"), "BD", AS_OF)
    flat = sinks.flat_outputs(paths)
    told = tables.read(spark, flat.pop("reportes.resumen")).filter("grupo = 'total'")
    parts = [_count(tables.read(spark, p), n) for n, p in flat.items()]
    return _together([*parts, told.select(F.lit("resumen").alias("tabla"), F.col("cantidad").alias("filas"))])


@query(
    cte("leave_rows")
    + """, silver AS (SELECT * FROM leave_rows WHERE dni IS NOT NULL AND periodo IS NOT NULL AND motivo IS NOT NULL),
pay AS (SELECT CAST(l_partkey AS VARCHAR) AS dni, strftime(l_shipdate, '%Y-%m') AS periodo FROM lineitem GROUP BY 1, 2)
SELECT 'silver' AS tabla, COUNT(*) AS filas FROM silver UNION ALL SELECT 'gold', COUNT(*) FROM pay
UNION ALL SELECT 'cobertura MOTIVO_CON_GOCE', COUNT(*) FROM pay WHERE EXISTS (
  SELECT 1 FROM silver s WHERE s.dni = pay.dni AND s.periodo = pay.periodo AND tipo = 'CON_GOCE')
UNION ALL SELECT 'cobertura MOTIVO_SIN_GOCE', COUNT(*) FROM pay WHERE EXISTS (
  SELECT 1 FROM silver s WHERE s.dni = pay.dni AND s.periodo = pay.periodo AND tipo = 'SIN_GOCE')
UNION ALL SELECT 'hallazgos', 0 UNION ALL SELECT 'valores', 0"""
)
def leave_run_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """A leave run from sheets to enriched payroll: staged, checked, published, and its coverage."""
    lines = table(spark, folder, "lineitem")
    pay = lines.select(F.col("l_partkey").cast("string").alias(leaves.DOCUMENT), F.date_format("l_shipdate", "yyyy-MM").alias(leaves.PERIOD)).distinct()
    paths = leaves.run(sheets.leave_sheets(spark, folder), pay, shared_folder(spark, "leave-run"), payroll_unique=True)
    covered = tables.read(spark, paths.pop("cobertura"))
    parts = [_count(tables.read(spark, p), n) for n, p in paths.items()]
    return _together([*parts, covered.select(F.concat(F.lit("cobertura "), "indicador").alias("tabla"), F.col("cantidad").alias("filas"))])


@query(
    cte("control_rows", "control_kept").rstrip()
    + """, days AS (SELECT date_diff('day', CAST(ingreso AS DATE), CAST(renovacion AS DATE)) AS dias FROM control_kept)
SELECT 'silver' AS tabla, COUNT(*) AS filas FROM days UNION ALL SELECT 'gold', COUNT(*) FROM days
UNION ALL SELECT f, 0 FROM (VALUES ('por_cumplir_1'), ('cumplio_1'), ('por_cumplir_2')) AS v(f)
UNION ALL SELECT 'sin dias', COUNT(*) FROM days WHERE dias IS NULL"""
)
def internship_run_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """An internship run read back; its gold table is stored in order, which the run checks."""
    paths = internships.run(sheets.control_sheets(spark, folder), shared_folder(spark, "intern-run"))
    gold = tables.read(spark, paths["gold"])
    told = tables.read(spark, paths["indicadores"]).select(F.col("indicador").alias("tabla"), F.col("cantidad").alias("filas"))
    parts = [_count(tables.read(spark, paths["silver"]), "silver"), _count(gold, "gold"), _count(gold.filter("dias_servicio IS NULL"), "sin dias")]
    return _together([*parts, told])
