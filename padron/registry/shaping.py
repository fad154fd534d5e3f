"""Queries over projection, casts, filters, unions and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions import cells as cell_rules
from padron.operators import rows, shape
from padron.plans import employees
from padron.plans.tables import INTERN_MODALITY
from padron.registry import frames
from padron.registry.common import Registry
from padron.registry.frames import cte, table
from padron.session import col, shared_folder
from padron.sources import sinks
from padron.sources.specs import FieldSpec, FilterSpec, TableSpec, spec_from_json

query = Registry()

PARTS = spec_from_json(
    {
        "columns": [
            {"name": "p_size", "type": "integer", "required": True},
            {"name": "p_color", "type": "string", "required": True},
            {"name": "p_name", "type": "string", "required": True},
            {"name": "p_partkey", "type": "integer", "required": True},
        ]
    },
    "parts",
)


# ---- selection, names, order -------------------------------------------------------------------


@query("SELECT p_partkey, p_name, p_size FROM part")
def schema_select_table_order(spark: SparkSession, folder: str) -> DataFrame:
    return shape.select_known(table(spark, folder, "part"), PARTS)[0]


@query("SELECT p_size, p_name, p_partkey FROM part")
def schema_select_spec_order(spark: SparkSession, folder: str) -> DataFrame:
    return shape.select_in_spec_order(table(spark, folder, "part"), PARTS)[0]


@query("SELECT p_partkey, p_brand, p_type FROM part")
def schema_select_required(spark: SparkSession, folder: str) -> DataFrame:
    return shape.select_required(table(spark, folder, "part"), ["p_partkey", "p_brand", "p_type"])


@query(
    """SELECT s_suppkey AS clave, s_name AS nombre, 'proveedor' AS origen FROM supplier
UNION ALL SELECT c_custkey, c_name, 'cliente' FROM customer"""
)
def rename_and_tag(spark: SparkSession, folder: str) -> DataFrame:
    """Several source names map to one target; each source is tagged before the union."""
    names = {"s_suppkey": "clave", "c_custkey": "clave", "s_name": "nombre", "c_name": "nombre"}
    tagged = [
        shape.with_constants(shape.rename_any(table(spark, folder, t), names), {"origen": tag})
        for t, tag in (("supplier", "proveedor"), ("customer", "cliente"))
    ]
    return shape.union_by_name([shape.select_required(t, ["clave", "nombre", "origen"]) for t in tagged])


@query("SELECT p_type, p_partkey, p_name, p_size, p_brand, p_retailprice FROM part")
def reorder_columns(spark: SparkSession, folder: str) -> DataFrame:
    front = shape.move_to_front(table(spark, folder, "part"), "p_type")
    return shape.insert_after(front, "p_size", "p_name")


@query(
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name,
  NULL::INTEGER AS s_nationkey, NULL::DOUBLE AS s_acctbal FROM customer
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"""
)
def diagonal_union(spark: SparkSession, folder: str) -> DataFrame:
    return shape.union_by_name([table(spark, folder, "customer"), table(spark, folder, "supplier")])


# ---- filters and splits ------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AND o_orderdate IS NOT NULL"""
)
def declared_filters(spark: SparkSession, folder: str) -> DataFrame:
    declared = [
        FilterSpec("o_orderpriority", "NOT_EQUAL", "5-LOW"),
        FilterSpec("o_orderstatus", "EQUAL", "F"),
        FilterSpec("o_orderdate", "IS_NOT_NULL"),
        FilterSpec("unknown_column", "IS_NULL"),
    ]
    kept, _ = rows.declared_filters(table(spark, folder, "orders"), declared)
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    cte("emp")
    + """SELECT "NUMERO DE DOC" AS doc FROM emp WHERE "Modalidad de Contrato" IS NULL"""
)
def filter_null_modality(spark: SparkSession, folder: str) -> DataFrame:
    declared = [FilterSpec(employees.MODALITY, "IS_NULL")]
    kept, _ = rows.declared_filters(frames.emp(spark, folder), declared)
    return kept.select(col(employees.KEY).alias("doc"))


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click') AND value BETWEEN 5 AND 50")
def membership_and_range(spark: SparkSession, folder: str) -> DataFrame:
    kept = (~F.col("event_type").isin("view", "click")) & F.col("value").between(5, 50)
    return table(spark, folder, "events").filter(kept).select("event_id", "event_type")


@query(
    cte("emp")
    + """SELECT "NUMERO DE DOC" AS doc, 'practicante' AS grupo FROM emp
WHERE contains("Modalidad de Contrato", 'TERMINO DE CONVENIO')
UNION ALL SELECT "NUMERO DE DOC", 'empleado' FROM emp
WHERE NOT contains("Modalidad de Contrato", 'TERMINO DE CONVENIO')"""
)
def split_by_modality(spark: SparkSession, folder: str) -> DataFrame:
    interns, others = rows.split_by_text(frames.emp(spark, folder), employees.MODALITY, INTERN_MODALITY)
    doc = col(employees.KEY).alias("doc")
    return interns.select(doc, F.lit("practicante").alias("grupo")).union(
        others.select(doc, F.lit("empleado").alias("grupo"))
    )


@query(
    cte("raw")
    + """SELECT numero, entero FROM raw WHERE numero IS NOT NULL OR entero IS NOT NULL"""
)
def drop_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_empty_rows(frames.raw(spark, folder).select("numero", "entero"))


@query(cte("raw") + "SELECT id, entero FROM raw WHERE entero IS NOT NULL")
def drop_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_null_key(frames.raw(spark, folder), "entero").select("id", "entero")


# ---- casts -------------------------------------------------------------------------------------

RAW = TableSpec(
    "raw",
    (
        FieldSpec("id", "integer"),
        FieldSpec("numero", "integer"),
        FieldSpec("entero", "integer"),
        FieldSpec("serie", "float"),
        FieldSpec("fecha", "date"),
        FieldSpec("codigo", "unknown type"),
    ),
)
_INT = r"CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN CAST({c} AS BIGINT) END"
_DOUBLE = r"CASE WHEN regexp_matches({c}, '^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST({c} AS DOUBLE) END"
_DATE = "CAST(CAST(try_strptime({c}, '%Y-%m-%d %H:%M:%S') AS DATE) AS VARCHAR)"


@query(
    cte("raw")
    + f"""SELECT id, {_INT.format(c="numero")} AS numero, {_INT.format(c="entero")} AS entero,
  {_DOUBLE.format(c="serie")} AS serie, {_DATE.format(c="fecha")} AS fecha, codigo FROM raw"""
)
def tolerant_cast(spark: SparkSession, folder: str) -> DataFrame:
    chosen = shape.select_in_spec_order(frames.raw(spark, folder), RAW)[0]
    return sinks.review_frame(shape.tolerant_cast(chosen, RAW))


@query(
    cte("raw")
    + f"""SELECT id, numero, {_INT.format(c="entero")} AS entero, serie, {_DATE.format(c="fecha")} AS fecha, codigo FROM raw"""
)
def strict_or_text_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Columns with a value that does not fit stay text; the clean one becomes a number."""
    chosen = shape.select_in_spec_order(frames.raw(spark, folder), RAW)[0]
    return sinks.review_frame(shape.strict_or_text_cast(chosen, RAW)[0])


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders")
def cast_to_text(spark: SparkSession, folder: str) -> DataFrame:
    chosen = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return shape.all_to_text(chosen, keep=["o_orderkey"])


@query(
    cte("raw")
    + r"""SELECT id, coalesce(trim(holgado, E' \t\n\r'), '') AS holgado, coalesce(trim(proyecto, E' \t\n\r'), '') AS proyecto
FROM raw"""
)
def trim_and_fill(spark: SparkSession, folder: str) -> DataFrame:
    chosen = frames.raw(spark, folder).select("id", "holgado", "proyecto")
    return shape.fill_text(shape.trim_text(chosen))


# ---- outputs -----------------------------------------------------------------------------------


@query(
    """SELECT copia, part.* FROM part, (VALUES ('actual'), ('historico')) AS v(copia)"""
)
def versioned_write(spark: SparkSession, folder: str) -> DataFrame:
    """Both copies of a versioned output, read back."""
    paths = sinks.write_versioned(table(spark, folder, "part"), shared_folder(spark, "versioned"), "part")
    sinks.missing_outputs(spark, paths)
    copies = [spark.read.parquet(path).withColumn("copia", F.lit(copy)) for copy, path in paths.items()]
    return copies[0].unionByName(copies[1])


@query(
    cte("emp")
    + """SELECT "NUMERO DE DOC" AS doc, strftime("FECH_INGR.", '%Y-%m-%d') AS ingreso FROM emp"""
)
def review_extract(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV extract, read back."""
    path = shared_folder(spark, "review")
    chosen = frames.emp(spark, folder).select(col(employees.KEY).alias("doc"), col(employees.HIRED).alias("ingreso"))
    sinks.write_review(chosen, path)
    return spark.read.csv(path, header=True, schema="doc string, ingreso string")


@query(
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'cerrados' ELSE 'otros' END AS rama, COUNT(*) AS filas FROM orders
GROUP BY 1"""
)
def split_write(spark: SparkSession, folder: str) -> DataFrame:
    """One stored table per non-empty branch, read back and counted."""
    orders = table(spark, folder, "orders")
    closed = F.col("o_orderstatus") == "F"
    branches = {
        "cerrados": orders.filter(closed),
        "otros": orders.filter(~closed),
        "vacia": orders.filter(F.col("o_orderkey").isNull()),
    }
    paths = sinks.write_split(branches, shared_folder(spark, "split"))
    counts = [
        spark.read.parquet(p["actual"]).agg(F.count(F.lit(1)).alias("filas")).withColumn("rama", F.lit(name))
        for name, p in paths.items()
    ]
    return shape.union_by_name(counts).select("rama", "filas")


@query(
    """SELECT strftime(o_orderdate, '%Y-%m') AS PERIODO, COUNT(*) AS filas FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01' GROUP BY 1"""
)
def partitioned_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts stored by period; the read touches the six periods asked for."""
    orders = table(spark, folder, "orders").withColumn("PERIODO", F.date_format("o_orderdate", "yyyy-MM"))
    path = shared_folder(spark, "facts")
    stored = sinks.write_current(orders, path, partition_by=["PERIODO"])
    wanted = stored.filter(F.col("PERIODO").between("1998-01", "1998-06"))
    return wanted.groupBy(F.col("PERIODO").cast("string").alias("PERIODO")).agg(F.count(F.lit(1)).alias("filas"))


@query(cte("raw") + r"SELECT id, trim(holgado, E' \t\n\r') AS holgado FROM raw")
def stripped_text(spark: SparkSession, folder: str) -> DataFrame:
    return frames.raw(spark, folder).select("id", cell_rules.strip(F.col("holgado")).alias("holgado"))
