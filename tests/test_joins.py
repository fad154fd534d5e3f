from collections import Counter

import pytest
from pyspark.sql import functions as F

from padron.operators import joins


def _frames(spark):
    """Half of the left rows share one key, some have none, some match nothing."""
    left = [("hot", "p", i) for i in range(400)]
    left += [(f"k{i % 50}", "p", 400 + i) for i in range(300)]
    left += [(None, "p", 700 + i) for i in range(80)] + [("k1", None, 790), ("absent", "p", 791)]
    left += [("hot", "p", 0)] * 5
    lookup = [("hot", "p", "H"), *[(f"k{i}", "p", f"v{i}") for i in range(50)], (None, "p", "never"), ("extra", "p", "x")]
    return (
        spark.createDataFrame(left, "`c.c` string, per string, id int").repartition(6),
        spark.createDataFrame(lookup, "`c.c` string, per string, val string"),
        Counter((k, p, i, dict(((a, b), v) for a, b, v in lookup if a).get((k, p))) for k, p, i in left),
    )


@pytest.mark.parametrize(
    "options", [{}, {"max_rows": 0}, {"check_size": False}, {"check_size": False, "spread_hot_keys": False}]
)
def test_every_path_gives_the_plain_left_join(spark, options):
    left, lookup, expected = _frames(spark)
    got = joins.lookup_join(left, lookup, ["c.c", "per"], **options)
    assert got.columns == ["c.c", "per", "id", "val"]
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_hot_key_is_always_found(spark):
    left, _, _ = _frames(spark)
    hot = left.filter("`c.c` = 'hot'").select(F.xxhash64("`c.c`", "per")).first()[0]
    assert hot in joins.hot_key_hashes(left, ["c.c", "per"], 0.1)
    assert len(joins.hot_key_hashes(left, ["c.c", "per"], 0.1)) <= 10


def test_hot_key_spreads_over_salts(spark):
    left, lookup, _ = _frames(spark)
    plan = joins.lookup_join(left, lookup, ["c.c", "per"], max_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_bounds_on_rows_and_bytes(spark):
    small = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert joins.bounded_copy(small, 10) is not None
    assert joins.bounded_copy(small, 9) is None
    assert joins.bounded_copy(small, 10, max_bytes=500) is None
    lists = spark.range(2).select(F.sequence(F.lit(1), F.lit(1000)).alias("a"))
    assert joins.bounded_copy(lists, 10, max_bytes=4000) is None
    assert joins.bounded_copy(lists, 10).collect() == lists.collect()


def test_few_but_very_wide_rows_take_the_shuffle_path(spark):
    wide = spark.createDataFrame([(str(i), "x" * 200_000) for i in range(20)], "k string, v string")
    assert joins.bounded_copy(wide, max_bytes=1_000_000) is None
    left = spark.createDataFrame([(str(i % 30), {"a": i}) for i in range(90)], "k string, m map<string,int>")
    joined = joins.lookup_join(left, wide, ["k"], max_rows=0)
    assert joined.filter("v IS NOT NULL").count() == 60
