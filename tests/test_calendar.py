import math
from datetime import date, timedelta

from pyspark.sql import functions as F

from padron.functions import calendar


def test_periods(column):
    names = ["Planilla 2024-03 a 2025-01.xlsx", "sin.xlsx", "2024-3.xlsx"]
    assert column(calendar.period_from_name, names) == ["2024-03", None, None]
    assert column(calendar.period_year, ["2024-03"]) == ["2024"]
    assert column(calendar.period_month, ["2024-03", "2024-xx", "2024"]) == [3, None, None]
    build = column(lambda m: calendar.build_period(F.lit(2024), m), ["1", "12", "123", None])
    assert build == ["2024-01", "2024-12", "2024-123", None]


def test_month_names_and_misses(column):
    assert column(calendar.month_name, [1, 9, 12, 0, 13, None], "int") == ["Enero", "Septiembre", "Diciembre", None, None, None]
    empty = column(lambda m: calendar.month_name(m, default=""), [1, 0, 13, None], "int")
    assert empty == ["Enero", "", "", None]


def test_service_text_keeps_words_when_hire_date_is_unknown(spark):
    rows = [(date(2015, 1, 1), None), (None, None), (date(2015, 1, 1), date(2017, 7, 2))]
    frame = spark.createDataFrame(rows, "s date, e date")
    text = calendar.service_text(F.col("s"), F.col("e"), F.lit("2020-01-01").cast("date"))
    assert [r[0] for r in frame.select(text).collect()] == ["4 años, 11 meses", " años,  meses", "2 años, 5 meses"]


def test_service_years_is_a_double(spark):
    frame = spark.createDataFrame([(date(2015, 1, 1), date(2019, 7, 3))], "s date, e date")
    out = frame.select(calendar.service_years(F.col("s"), F.col("e"), F.current_date()).alias("y"))
    assert out.dtypes == [("y", "double")]
    assert out.first()[0] == 1644 / 365.25


def test_age_flags(spark):
    frame = spark.createDataFrame([(date(1935, 6, 1),), (date(1936, 1, 1),), (date(1930, 1, 1),), (None,)], "b date")
    flags = calendar.age_flags(F.col("b"), F.lit("2000-01-01").cast("date"))
    got = [tuple(r) for r in frame.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    assert list(flags) == ["cumple_65_esteaño", "cumple_65_proximoaño", "cumple_70_esteaño", "cumple_70_proximoaño"]
    assert got == [
        (True, False, False, False), (False, True, False, False), (False, False, True, False), (None,) * 4,
    ]


def test_contract_alerts_use_three_valued_logic(spark):
    obra, other = calendar.CONTRACT_RULES[0].modality, "PLAZO INDETERMINADO"
    frame = spark.createDataFrame([(obra, 4.5), (obra, 4.49), (obra, None), (other, None), (None, 9.0)], "m string, y double")
    alert = calendar.contract_alerts(F.col("m"), F.col("y"))["alerta_contrato_obra"]
    assert [r[0] for r in frame.select(alert).collect()] == [True, False, None, False, None]


def _phrase(days):
    """The phrase by plain arithmetic, for a condition without limits."""
    years, months = math.floor(days / 365.25), math.floor(math.fmod(days, 365.25) / 30.44)
    if years == 0:
        return f"{months} meses"
    head = "1 año" if years == 1 else f"{years} años"
    return head if months == 0 else f"{head} y {months} meses"


def test_tenure_against_plain_arithmetic(spark):
    start = date(2000, 1, 1)
    spans = list(range(-400, 3000))
    rows = [(d, start, start + timedelta(days=d)) for d in spans]
    frame = spark.createDataFrame(rows, "d int, s date, e date")
    parts = calendar.tenure_parts(F.col("s"), F.col("e"))
    frame = frame.select("d", *[c.alias(n) for n, c in parts.items()])
    frame = frame.withColumn("p", calendar.tenure_phrase(F.col("anios_servicio"), F.col("meses_servicio"), F.lit("NO"), F.lit("NO")))
    for row in frame.collect():
        assert row["dias_servicio"] == row["d"]
        assert row["p"] == _phrase(row["d"])


def test_tenure_flags_and_limit_messages(spark):
    pro = calendar.TENURE_RULES.condition
    days = [334, 335, 364, 365, 639, 640, 729, 730, None]
    frame = spark.createDataFrame([(i, pro, d) for i, d in enumerate(days)] + [(99, "OTRA", 340)], "i int, c string, d int")
    flags = calendar.tenure_flags(F.col("c"), F.col("d"))
    got = {r["i"]: (r["por_cumplir_1"], r["cumplio_1"], r["por_cumplir_2"]) for r in frame.withColumns(flags).collect()}
    assert got[0] == ("NO", "NO", "NO")
    assert got[1] == got[2] == ("SI", "NO", "NO")
    assert got[3] == got[4] == ("NO", "SI", "NO")
    assert got[5] == got[6] == ("NO", "SI", "SI")
    assert got[7] == ("NO", "SI", "NO")
    assert got[8] == (None, None, None)
    assert got[99] == ("NO", "NO", "NO")
    limits = spark.createDataFrame([(0, 11, "SI", "NO"), (1, 9, "NO", "SI"), (1, 9, "NO", "NO")], "y int, m int, a string, b string")
    phrase = calendar.tenure_phrase(*[F.col(c) for c in "ymab"])
    assert [r[0] for r in limits.select(phrase).collect()] == ["1 año (En límite)", "2 años (Límite Máximo)", "1 año y 9 meses"]


def test_match_status(spark):
    frame = spark.createDataFrame([("", None), (None, None), ("a", None), ("a", "a"), ("", "")], "c string, k string")
    got = [r[0] for r in frame.select(calendar.match_status(F.col("c"), F.col("k"))).collect()]
    assert got == ["SIN_CODIGO", "CODIGO_NO_ENCONTRADO", "CODIGO_NO_ENCONTRADO", "OK", "SIN_CODIGO"]
