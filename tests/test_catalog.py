import random

from padron.operators import catalog
from padron.plans import exams


def test_keep_first_equals_a_loop_and_is_stable(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "hot", "hot", "hot", None]), f"v{i}", i) for i in range(500)]
    frame = spark.createDataFrame(rows, "CC string, v string, row_idx int").repartition(5)
    once = catalog.keep_first(frame, "CC", ["row_idx"])
    expected = {}
    for key, v, _ in rows:
        expected.setdefault(key, v)
    assert {r.CC: r.v for r in once.collect()} == expected
    twice = catalog.keep_first(once, "CC", ["row_idx"])
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_rank_is_limited_before_the_shuffle(spark):
    frame = spark.createDataFrame([("a", 1)], "CC string, row_idx int")
    plan = catalog.keep_first(frame.repartition(4), "CC", ["row_idx"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


COLUMNS = "CC string, `NOMBRE CC` string, `CATEGORIA CC` string, GERENCIA string, orden int"


def test_current_catalogue_wins_even_with_nulls(spark):
    current = spark.createDataFrame([("1", None, "c", "g", 2), ("1", "later", "c", "g", 3)], COLUMNS)
    older = spark.createDataFrame([("1", "old", "o", "o", 1), ("2", "only old", "o", "o", 1)], COLUMNS)
    merged = exams.unified_catalogue(current, older, ("orden",))
    assert {r.CC: r["NOMBRE CC"] for r in merged.collect()} == {"1": None, "2": "only old"}


def test_enrichment_keeps_every_exam(spark):
    schema = "NOMBRE string, `NOMBRE DE CC` string"
    people = spark.createDataFrame([("a", "1"), ("b", ""), ("c", None), ("d", "9"), ("e", "1")], schema)
    catalogue = spark.createDataFrame([("1", "uno", "x", "g", 1)], COLUMNS).drop("orden")
    for bound in (100, 0):
        got = {r.NOMBRE: (r.codigo_cc, r.status_match) for r in exams.enrich(people, catalogue, bound).collect()}
        assert got == {
            "a": ("1", "OK"), "b": (None, "SIN_CODIGO"), "c": (None, "CODIGO_NO_ENCONTRADO"),
            "d": (None, "CODIGO_NO_ENCONTRADO"), "e": ("1", "OK"),
        }
