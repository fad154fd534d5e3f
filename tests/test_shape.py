from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from padron.functions import cells
from padron.operators import shape
from padron.sources.specs import FieldSpec, TableSpec

SPEC = TableSpec("t", (FieldSpec("b", "integer"), FieldSpec("z"), FieldSpec("a.x", "float")))


def test_selection_orders(spark):
    frame = spark.createDataFrame([("1", "2", "3")], "`a.x` string, other string, b string")
    known, missing = shape.select_known(frame, SPEC)
    assert (known.columns, missing) == (["a.x", "b"], ["z"])
    ordered, missing = shape.select_in_spec_order(frame, SPEC)
    assert (ordered.columns, missing) == (["b", "a.x"], ["z"])
    with pytest.raises(ValueError, match="z"):
        shape.select_required(frame, SPEC.columns)
    assert shape.select_required(frame, ["b", "a.x"]).columns == ["b", "a.x"]


def test_rename_and_reorder(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "a int, `b.c` int, d int")
    renamed = shape.rename_any(frame, {"b.c": "X", "absent": "X"})
    assert renamed.columns == ["a", "X", "d"]
    with pytest.raises(ValueError):
        shape.rename_any(frame, {"a": "X", "b.c": "X"})
    assert shape.move_to_front(frame, "d").columns == ["d", "a", "b.c"]
    assert shape.insert_after(frame, "d", "a").columns == ["a", "d", "b.c"]
    assert shape.with_constants(frame, {"k": "v"}).first()["k"] == "v"


def test_union_keeps_first_seen_order_and_fills_with_null(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    merged = shape.union_by_name([a, b])
    assert merged.columns == ["a", "b", "c"]
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([(1, "x", None), (None, "y", 2.0)], key=str)


def test_text_operators(spark):
    frame = spark.createDataFrame([(1, " a\n", None), (2, None, "　b")], "i int, `x.y` string, z string")
    assert [tuple(r) for r in shape.trim_text(frame).collect()] == [(1, "a", None), (2, None, "b")]
    assert [tuple(r) for r in shape.fill_text(frame).collect()] == [(1, " a\n", ""), (2, "", "　b")]
    assert shape.all_to_text(frame, keep=["z"]).dtypes == [("i", "string"), ("x.y", "string"), ("z", "string")]


CASTS = TableSpec(
    "c",
    (FieldSpec("i", "integer"), FieldSpec("f", "float"), FieldSpec("b", "boolean"), FieldSpec("d", "date"), FieldSpec("u", "money")),
)


def _texts(spark):
    rows = [
        ("12", "1.5", "true", "2024-01-02 00:00:00", "a"),
        ("12.0", "1e3", "TRUE", "2024-01-02", "b"),
        (" 7", "1.5d", "false", None, None),
        (None, None, None, "x", "c"),
    ]
    return spark.createDataFrame(rows, "i string, f string, b string, d string, u string")


def test_tolerant_cast(spark):
    out = shape.tolerant_cast(_texts(spark), CASTS)
    assert out.dtypes == [("i", "bigint"), ("f", "double"), ("b", "boolean"), ("d", "date"), ("u", "string")]
    assert [tuple(r) for r in out.collect()] == [
        (12, 1.5, True, date(2024, 1, 2), "a"),
        (None, 1000.0, None, None, "b"),
        (None, None, False, None, None),
        (None, None, None, None, "c"),
    ]
    relaxed = shape.tolerant_cast(_texts(spark), CASTS, int_from_decimal_text=True)
    assert [r["i"] for r in relaxed.collect()] == [12, 12, None, None]
    again = shape.tolerant_cast(out, CASTS)
    assert again.collect() == out.collect()


def test_cast_from_typed_columns(spark):
    frame = spark.createDataFrame([(3, datetime(2024, 1, 2, 5))], "i int, d timestamp_ntz")
    out = shape.tolerant_cast(frame, CASTS).first()
    assert (out["i"], out["d"]) == (3, date(2024, 1, 2))


def test_strict_cast_keeps_the_whole_column_as_text(spark):
    frame = _texts(spark)
    out, kept = shape.strict_or_text_cast(frame, CASTS)
    assert kept == ["i", "f", "b"]
    assert out.dtypes == [("i", "string"), ("f", "string"), ("b", "string"), ("d", "date"), ("u", "string")]
    clean, kept = shape.strict_or_text_cast(frame.filter("i = '12'"), CASTS)
    assert kept == [] and clean.schema["i"].dataType.simpleString() == "bigint"


def test_date_parser_is_an_option(spark):
    frame = spark.createDataFrame([("2024-01-02 00:00:00.5",)], "d string")
    spec = TableSpec("d", (FieldSpec("d", "date"),))
    assert shape.tolerant_cast(frame, spec).first()[0] is None
    parsed = shape.tolerant_cast(frame, spec, parse_date=cells.fractional_datetime_text_to_date)
    assert parsed.first()[0] == date(2024, 1, 2)


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.col("id").alias("b"), F.lit("x").alias("c")).write.parquet(path)
    chosen, _ = shape.select_known(spark.read.parquet(path), SPEC)
    plan = chosen.filter("b > 5")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(b,5)" in plan and "ReadSchema: struct<b:bigint>" in plan
