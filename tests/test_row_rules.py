import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from padron.functions import flag_rules
from padron.operators import quality
from padron.operators.row_rules import RowRule, RuleError, broken_tests, rule_from_json
from padron.sources.queries import run_sql
from padron.sources.specs import FieldSpec, TableSpec, spec_from_json

ROW = "k string, start date, end date, why string, a double, b double, net double, period string, txt string"


def broken(spark, test, *rows):
    frame = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], ROW)
    (column,) = broken_tests([RowRule("r", test)], frame.schema).values()
    return [int(r["k"]) for r in frame.filter(F.coalesce(column, F.lit(False))).orderBy("k").collect()]


def row(start=None, end=None, why=None, a=None, b=None, net=None, period=None, txt=None):
    return (start, end, why, a, b, net, period, txt)


def test_comparisons_and_what_missing_values_leave_open(spark):
    one, two = date(2024, 1, 5), date(2024, 2, 5)
    rows = [row(one, two), row(two, one), row(one, one), row(None, one), row(one, None), row(None, None)]
    assert broken(spark, {"compare": ["end", ">", "start"]}, *rows) == [1, 2]
    assert broken(spark, {"not": {"compare": ["end", ">", "start"]}}, *rows) == [0]
    texts = [row(start=one, txt="2024-01-06"), row(start=one, txt="2024-01-04"), row(start=one, txt="soon"), row(txt="2024-01-04")]
    assert broken(spark, {"compare": ["start", "<=", "txt"]}, *texts) == [1]
    assert broken(spark, {"compare": ["txt", ">=", {"value": 10}]}, row(txt="9.5"), row(txt="10"), row(txt="x"), row()) == [0]
    periods = [row(start=date(2024, 1, 31), period="2024-01"), row(start=date(2024, 2, 1), period="2024-01"), row(start=one, period="bad")]
    assert broken(spark, {"compare": ["start", "<=", {"period_end": "period"}]}, *periods) == [1]


def test_implication_presence_and_sums(spark):
    day = date(2024, 1, 5)
    rows = [row(end=day, why="left"), row(why="left"), row(why="  "), row(end=day), row()]
    assert broken(spark, {"if": {"set": "why"}, "then": {"set": "end"}}, *rows) == [1]
    assert broken(spark, {"any": [{"unset": "why"}, {"set": "end"}]}, *rows) == [1]
    sums = [row(a=10.0, b=4.0, net=6.0), row(a=10.0, b=4.0, net=6.01), row(a=10.0, b=4.0, net=6.5), row(a=10.0, net=1.0)]
    assert broken(spark, {"sum": {"a": 1, "b": -1}, "equals": "net", "tolerance": 0.0101}, *sums) == [2]
    limits = [row(a=0.0), row(a=31.0), row(a=31.5), row(a=-1.0), row()]
    assert broken(spark, {"between": ["a", 0, 31]}, *limits) == [2, 3]
    assert broken(spark, {"all": [{"between": ["a", 0, 31]}, {"unset": "b"}]}, *limits, row(a=1.0, b=1.0)) == [2, 3, 5]


def test_rules_from_documents(spark):
    document = {
        "schema": {"k": {"type": "string"}, "a": {"type": "float"}},
        "constraints": {
            "primary_key": [],
            "unique_keys": [["k", "a"], "why"],
            "row_rules": [{"name": "a is small", "test": {"compare": ["a", "<", 5]}, "severity": "aviso"},
                          {"name": "not there", "test": {"set": "gone"}}],
        },
    }
    spec = spec_from_json(json.loads(json.dumps(document)), "t")
    assert spec.unique_keys == (("k", "a"), ("why",))
    frame = spark.createDataFrame([("x", 9.0, "p"), ("x", 9.0, "p"), (None, 1.0, "p"), (None, 1.0, None)], "k string, a double, why string")
    found = {tuple(r) for r in quality.constraint_findings(frame, spec).collect()}
    assert found == {("a is small", "fila", "aviso", 2, "a"), ("k, a", "unica", "error", 1, ""), ("why", "unica", "error", 1, "")}
    for bad in ({"name": "x", "test": {"less": 1}}, {"test": {}}, {"name": "x", "test": {"compare": [{"colour": 1}, "<", 1]}}):
        with pytest.raises(RuleError):
            rule_from_json(bad)
    with pytest.raises(RuleError):
        broken_tests([RowRule("r", {"compare": ["a", "~", 1]})], frame.schema)


def test_every_bad_value_is_a_row(spark):
    spec = TableSpec("t", (FieldSpec("s", allowed=("M", "F")), FieldSpec("n", "integer", minimum=0, maximum=9), FieldSpec("x", pattern="^v")))
    frame = spark.range(10_000).selectExpr("concat('v', id) AS s", "cast(id % 20 - 5 AS int) AS n", "concat('v', id) AS x", "concat('f', id % 7) AS f", "id")
    found = quality.bad_values(frame.unionByName(frame), spec, ["f", "id"])
    assert found.filter("regla = 'valores' AND filas = 2").count() == 10_000
    assert [tuple(r) for r in found.filter("valor = 'v13'").collect()] == [("s", "valores", "v13", 2, "f6 13")]
    assert found.filter("regla = 'minimo'").count() == 5
    assert quality.bad_values(frame, spec, ["f"], extras=True).filter("regla = 'maximo'").count() == 5
    assert quality.bad_values(frame, TableSpec("e", ()), ["f"]).count() == 0


RULES = {
    "reglas_edad": {"edad_65": {"edad_objetivo": 65, "alertas": {"cumple_este_año": {"columna_resultado": "c65"}, "cumple_proximo_año": {"columna_resultado": "p65"}}},
                    "edad_70": {"edad_objetivo": 70, "activo": False, "alertas": {"cumple_este_año": {"columna_resultado": "c70"}, "cumple_proximo_año": {"columna_resultado": "p70"}}}},
    "reglas_contrato": [
        {"modalidad": "OBRA", "alerta_desde_años": 4.5, "alerta_hasta_años": 5.0, "columna_resultado": "obra", "activo": True},
        {"modalidad": "TEMPORAL", "alerta_desde_meses": 30, "columna_resultado": "obra"},
        {"modalidad": "OBRA", "alerta_desde_años": 1, "columna_resultado": "antes", "valido_hasta": "1999-12-31"},
        {"modalidad": "OBRA", "alerta_desde_años": 1, "columna_resultado": "apagada", "activo": False},
        {"modalidad": "LIBRE", "alerta_desde_años": 0, "columna_resultado": "obra"},
    ],
    "contratos_excluidos": [{"modalidad": "LIBRE", "aplica_alertas_edad": False, "aplica_alertas_contrato": False}],
}


def flagged(spark, rules, as_of, people):
    frame = spark.createDataFrame(people, "modality string, years double, birth date")
    day = F.lit(as_of).cast("date")
    columns = {
        **flag_rules.age_columns(rules, F.col("birth"), F.col("modality"), day),
        **flag_rules.contract_columns(rules, F.col("modality"), F.col("years"), day),
    }
    return [tuple(r) for r in frame.select(*[c.alias(n) for n, c in columns.items()]).collect()], list(columns)


def test_flag_rules_from_a_document(spark):
    rules = flag_rules.rules_from_json(RULES)
    people = [("OBRA", 4.6, date(1935, 5, 5)), ("OBRA", 5.0, date(1936, 1, 1)), ("TEMPORAL", 2.5, None), ("LIBRE", 9.0, date(1935, 1, 1)), ("X", 9.0, None), (None, 1.0, None), ("OBRA", None, None)]
    found, names = flagged(spark, rules, "2000-06-01", people)
    assert names == rules.columns == ["c65", "p65", "obra", "antes"]
    assert found == [
        (True, False, True, False), (False, True, False, False), (None, None, True, False), (False, False, False, False),
        # An unknown contract type, or an unknown service time, leaves open what some rule could make true.
        (None, None, False, False), (None, None, None, False), (None, None, None, False),
    ]
    before, _ = flagged(spark, rules, "1999-06-01", people[:1])
    assert before == [(False, True, True, True)]


def test_flag_rules_from_a_table(spark):
    table = spark.createDataFrame([("OBRA", "o", 1.5, None, True), ("OBRA", "o2", 3.0, 4.0, None), ("B", "o", 0.5, None, False)], "modalidad string, columna string, desde double, hasta double, activo boolean")
    rules = flag_rules.rules_from_table(table, flag_rules.FlagRules())
    found, names = flagged(spark, rules, "2000-01-01", [("OBRA", 3.5, None), ("OBRA", 1.0, None), ("B", 9.0, None)])
    assert names == ["o", "o2"] and found == [(True, True), (False, False), (False, False)]
    with pytest.raises(flag_rules.FlagRuleError):
        flag_rules.rules_from_table(spark.createDataFrame([("A", "o", 3.0, 2.0)], "modalidad string, columna string, desde double, hasta double"))
    many = spark.range(flag_rules.MAX_RULES + 1).selectExpr("'A' AS modalidad", "'c' AS columna", "1.0D AS desde")
    with pytest.raises(flag_rules.FlagRuleError):
        flag_rules.rules_from_table(many)


def test_sql_names_hold_for_one_call(spark):
    spark.range(3).createOrReplaceTempView("t")
    one = run_sql(spark, "WITH u AS (SELECT id + :n AS id FROM t) SELECT * FROM u ORDER BY id", {"t": spark.range(5)}, {"n": 10})
    two = run_sql(spark, "SELECT count(*) AS n FROM t", {"t": spark.range(7)})
    assert [r[0] for r in one.collect()] == [10, 11, 12, 13, 14] and two.first()[0] == 7
    assert spark.table("t").count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("t_")] == []
    assert run_sql(spark, "SELECT 1 AS x", {}).first()[0] == 1
    spark.catalog.dropTempView("t")
