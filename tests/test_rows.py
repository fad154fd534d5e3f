import random

import pytest
from pyspark.sql import functions as F

from padron.functions import cells
from padron.operators import rows
from padron.operators.joins import lookup_join
from padron.sources.specs import FilterSpec


def _grids(seed, sheets=12, longest=60, blank=0.3):
    rng = random.Random(seed)
    out = []
    for s in range(sheets):
        for i in range(1, rng.randint(1, longest) + 1):
            out.append((f"f{s % 4}", f"s{s}", i, rng.choice([None, "", " "]) if rng.random() < blank else f"k{i}"))
    return out


def _by_sheet(data):
    sheets = {}
    for f, s, i, k in data:
        sheets.setdefault((f, s), []).append((i, k))
    return sheets


def _blank(k):
    return k is None or not k.strip()


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bound", [50_000, 0])
def test_stop_at_first_blank_equals_a_loop(spark, seed, bound):
    data = _grids(seed)
    frame = spark.createDataFrame(data, "file string, sheet string, row_idx int, k string")
    cuts = frame.filter(cells.is_blank(F.col("k"))).groupBy("file", "sheet").agg(F.min("row_idx").alias("_cut"))
    marked = lookup_join(frame, cuts, ["file", "sheet"], max_rows=bound)
    got = {tuple(r)[:3] for r in marked.filter("_cut IS NULL OR row_idx < _cut").collect()}
    if bound:
        assert got == {tuple(r)[:3] for r in rows.stop_at_first(frame, cells.is_blank(F.col("k"))).collect()}
    expected = set()
    for (f, s), lines in _by_sheet(data).items():
        for i, k in lines:
            if _blank(k):
                break
            expected.add((f, s, i))
    assert got == expected


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", [2, 3, 5])
def test_blank_run_equals_a_loop(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(rows, "BLOCK_BUCKETS", 3)
    data = _grids(seed, longest=120, blank=0.6)
    frame = spark.createDataFrame(data, "file string, sheet string, row_idx int, k string")
    got = {tuple(r)[:3] for r in rows.stop_after_blank_run(frame, F.col("k"), limit).collect()}
    expected = set()
    for (f, s), lines in _by_sheet(data).items():
        run, started = 0, False
        for i, k in lines:
            if _blank(k):
                run += started
                if run >= limit:
                    break
                continue
            run, started = 0, True
            expected.add((f, s, i))
    assert got == expected


def test_blank_run_of_a_thousand(spark):
    keyed = [("f", "s", i, "k") for i in [1500, 2500, 3501, 3502]]
    frame = spark.createDataFrame(keyed, "file string, sheet string, row_idx int, k string")
    kept = sorted(r["row_idx"] for r in rows.stop_after_blank_run(frame, F.col("k")).collect())
    assert kept == [1500, 2500]  # 999 rows without a key are passed over, 1000 are not


def test_footer_rule(column):
    values = [None, "", "x", "Total general de la planilla", "123456789012345678901234567890", "2024-01-01 00:00:00"]
    assert column(rows.is_data_row, values) == [False, True, True, False, True, True]


def test_empty_and_keyless_rows(spark):
    frame = spark.createDataFrame([(None, None), (1, None), (None, "")], "`a.b` int, c string")
    assert rows.drop_empty_rows(frame).count() == 2
    assert rows.drop_null_key(frame, "a.b").count() == 1
    assert rows.drop_blank_key(frame, F.col("c")).count() == 0


def test_empty_row_filter_plans_fast_on_many_renamed_columns(spark):
    wide = spark.range(3).select(*[F.when(F.col("id") != i, F.col("id")).alias(f"c{i}") for i in range(40)])
    renamed = rows.drop_empty_rows(wide).select(*[F.col(c).alias(c.upper()) for c in wide.columns])
    assert renamed.count() == 3


def test_declared_filters_drop_nulls_and_report_unknown_columns(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    kept, skipped = rows.declared_filters(frame, [FilterSpec("c", "NOT_EQUAL", "a"), FilterSpec("z", "IS_NULL")])
    assert [r.c for r in kept.collect()] == ["b"]
    assert skipped == ["z"]
    assert rows.declared_filters(frame, [FilterSpec("c", "EQUAL", "a")])[0].count() == 1
    assert rows.declared_filters(frame, [FilterSpec("c", "IS_NULL")])[0].count() == 1
    assert rows.declared_filters(frame, [FilterSpec("c", "IS_NOT_NULL")])[0].count() == 2


def test_split_leaves_nulls_out(spark):
    frame = spark.createDataFrame([("x TERMINO DE CONVENIO",), ("y",), (None,)], "m string")
    found, other = rows.split_by_text(frame, "m", "TERMINO DE CONVENIO")
    assert (found.count(), other.count()) == (1, 1)
    with pytest.raises(ValueError):
        rows.split_by_text(frame, "n", "x")
