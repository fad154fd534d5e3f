"""Queries over cell normalisers, months and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions import calendar
from padron.functions import cells as rules
from padron.registry import frames
from padron.registry.common import Registry
from padron.registry.frames import cte, table

query = Registry()

_MONTHS = "[" + ", ".join(f"'{m}'" for m in calendar.MONTHS) + "]"


@query(
    f"""SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS mes, {_MONTHS}[month(o_orderdate)] AS nombre,
  CASE WHEN o_orderkey % 15 BETWEEN 1 AND 12 THEN {_MONTHS}[o_orderkey % 15] END AS nombre_o_nulo,
  CASE WHEN o_orderkey % 15 BETWEEN 1 AND 12 THEN {_MONTHS}[o_orderkey % 15]
    WHEN o_orderkey % 15 <> 14 THEN '' END AS nombre_o_vacio
FROM orders"""
)
def month_name(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("o_orderkey") % 15
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.month("o_orderdate").alias("mes"),
        calendar.month_name(F.month("o_orderdate")).alias("nombre"),
        calendar.month_name(number).alias("nombre_o_nulo"),
        calendar.month_name(F.when(number != 14, number), default="").alias("nombre_o_vacio"),
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS periodo,
  year(o_orderdate) || '-' || CASE WHEN o_custkey % 200 < 10 THEN '0' ELSE '' END || (o_custkey % 200) AS periodo_libre
FROM orders"""
)
def period_build(spark: SparkSession, folder: str) -> DataFrame:
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        calendar.build_period(year, month).alias("periodo"),
        calendar.build_period(year, F.col("o_custkey") % 200).alias("periodo_libre"),
    )


_NAME = """CASE WHEN o_orderkey % 19 = 0 THEN 'Planilla sin periodo.xlsx'
  WHEN o_orderkey % 19 = 1 THEN 'Planilla 2024-xx Empleados.xlsx'
  ELSE 'Planilla ' || strftime(o_orderdate, '%Y-%m') || ' al 2030-01.xlsx' END"""


@query(
    rf"""WITH n AS (SELECT o_orderkey, nullif(regexp_extract({_NAME}, '(\d{{4}}-\d{{2}})', 1), '') AS periodo FROM orders)
SELECT *, substr(periodo, 1, 4) AS anio, TRY_CAST(substr(periodo, 6, 2) AS INTEGER) AS mes FROM n"""
)
def period_parts(spark: SparkSession, folder: str) -> DataFrame:
    name = F.expr(
        """CASE WHEN o_orderkey % 19 = 0 THEN 'Planilla sin periodo.xlsx'
        WHEN o_orderkey % 19 = 1 THEN 'Planilla 2024-xx Empleados.xlsx'
        ELSE concat('Planilla ', date_format(o_orderdate, 'yyyy-MM'), ' al 2030-01.xlsx') END"""
    )
    period = F.col("periodo")
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", calendar.period_from_name(name).alias("periodo"))
        .select("o_orderkey", period, calendar.period_year(period).alias("anio"), calendar.period_month(period).alias("mes"))
    )


# ---- dates -------------------------------------------------------------------------------------

_LAYOUTS = (
    ("%Y-%m-%d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("%d/%m/%Y", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("%d-%m-%Y", r"^\d{1,2}-\d{1,2}-\d{4}$"),
    ("%Y/%m/%d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("%d.%m.%Y", r"^\d{1,2}\.\d{1,2}\.\d{4}$"),
)
_LAYOUT_DATE = "coalesce(" + ", ".join(
    f"CASE WHEN regexp_matches(fecha, '{shape}') THEN try_strptime(fecha, '{layout}') END" for layout, shape in _LAYOUTS
) + ")"


@query(cte("raw") + f"SELECT id, strftime({_LAYOUT_DATE}, '%Y-%m-%d') AS fecha FROM raw")
def date_multi_format(spark: SparkSession, folder: str) -> DataFrame:
    parsed = rules.layout_date(F.col("fecha"))
    return frames.raw(spark, folder).select("id", F.date_format(parsed, "yyyy-MM-dd").alias("fecha"))


@query(
    cte("raw")
    + r"""SELECT id, strftime(DATE '1899-12-30' + CASE WHEN TRY_CAST(serie AS DOUBLE) BETWEEN -693593 AND 2958465
  THEN CAST(FLOOR(TRY_CAST(serie AS DOUBLE)) AS INTEGER) END, '%Y-%m-%d') AS fecha FROM raw"""
)
def serial_date(spark: SparkSession, folder: str) -> DataFrame:
    parsed = rules.serial_date(F.col("serie"))
    return frames.raw(spark, folder).select("id", F.date_format(parsed, "yyyy-MM-dd").alias("fecha"))


@query(
    cte("raw")
    + r"""SELECT id, CASE WHEN regexp_matches(fecha, '^\d{1,2}/\d{1,2}/\d{4}$')
  THEN coalesce(strftime(try_strptime(fecha, '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S'), fecha) ELSE fecha END AS texto
FROM raw"""
)
def slash_date_text(spark: SparkSession, folder: str) -> DataFrame:
    return frames.raw(spark, folder).select(
        "id", rules.slash_date_to_datetime_text(F.col("fecha")).alias("texto")
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS texto, strftime(ts, '%Y-%m-%d') AS dia FROM events")
def datetime_text(spark: SparkSession, folder: str) -> DataFrame:
    text = rules.datetime_text(F.col("ts"))
    return table(spark, folder, "events").select(
        "event_id",
        text.alias("texto"),
        F.date_format(rules.datetime_text_to_date(text), "yyyy-MM-dd").alias("dia"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS dia, NULL::VARCHAR AS sin_fraccion FROM events WHERE microsecond(ts) % 1000000 <> 0")
def fractional_datetime_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text with fractions is read by the fractional rule and refused by the exact one."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    events = table(spark, folder, "events").filter(F.date_format("ts", "SSSSSS") != "000000")
    return events.select(
        "event_id",
        F.date_format(rules.fractional_datetime_text_to_date(text), "yyyy-MM-dd").alias("dia"),
        F.date_format(rules.datetime_text_to_date(text), "yyyy-MM-dd").alias("sin_fraccion"),
    )


# ---- numbers and codes -------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, regexp_replace(printf('%.6f', CAST(o_custkey AS DOUBLE) / 4), '\\.?0+$', '') AS cuarto,
  regexp_replace(printf('%.6f', o_totalprice), '\\.?0+$', '') AS importe FROM orders""".replace("\\\\", "\\")
)
def number_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        rules.number_text(F.col("o_custkey").cast("double") / 4).alias("cuarto"),
        rules.number_text(F.col("o_totalprice")).alias("importe"),
    )


@query(cte("raw") + r"SELECT id, regexp_replace(numero, '\.0$', '') AS numero FROM raw")
def strip_dot_zero(spark: SparkSession, folder: str) -> DataFrame:
    return frames.raw(spark, folder).select("id", rules.strip_dot_zero(F.col("numero")).alias("numero"))


@query(
    cte("raw")
    + """SELECT id, CASE WHEN NOT starts_with(codigo, '#') THEN codigo END AS sin_error,
  CASE WHEN regexp_matches(codigo, '#N/D|#N/A') OR contains(lower(codigo), 'error') THEN NULL ELSE codigo END AS codigo,
  CASE WHEN palabra IN ('None', 'nan', 'NaT') THEN NULL ELSE palabra END AS palabra
FROM raw"""
)
def sentinels(spark: SparkSession, folder: str) -> DataFrame:
    return frames.raw(spark, folder).select(
        "id",
        rules.error_cell_to_null(F.col("codigo")).alias("sin_error"),
        rules.sentinel_to_null(F.col("codigo")).alias("codigo"),
        rules.null_words_to_null(F.col("palabra")).alias("palabra"),
    )


@query(
    cte("raw")
    + """SELECT id, CASE WHEN proyecto IS NULL OR proyecto = '0' OR trim(proyecto) = '' THEN 'Staff' ELSE proyecto END
    AS proyecto,
  CASE WHEN proyecto IS NULL OR proyecto = '' THEN 'Personal_Interno' ELSE proyecto END AS servicio,
  coalesce(proyecto, 'POR DEFINIR') AS universidad
FROM raw"""
)
def imputations(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("proyecto")
    return frames.raw(spark, folder).select(
        "id",
        rules.staff_default(value).alias("proyecto"),
        rules.empty_default(value).alias("servicio"),
        rules.null_default(value).alias("universidad"),
    )


# The upper case of 'ß' is 'SS'; the checking engine would write the capital letter instead.
@query(
    r"""SELECT conv_id, turn, upper(replace(regexp_replace(trim(text, E' \t\n\r'), '\s+', ' ', 'g'), 'ß', 'ss')) AS clave
FROM conversations"""
)
def header_key(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select("conv_id", "turn", rules.header_key(F.col("text")).alias("clave"))
