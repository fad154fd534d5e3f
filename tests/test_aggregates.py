import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from padron.operators import aggregates as agg


def test_ordered_text_keeps_repeats_and_order(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), rng.choice(["x", "y"]), rng.choice(["B", "A", "Z", "é", None]), rng.choice(["P", "S", "Q"])) for _ in range(300)]
    frame = spark.createDataFrame(rows, "k string, p string, v string, t string")
    got = {(r.k, r.p): (r.paid, r.unpaid) for r in agg.ordered_text(frame, ["k", "p"], "v", "t", {"P": "paid", "S": "unpaid"}).collect()}
    groups = defaultdict(lambda: {"P": [], "S": []})
    for k, p, v, t in rows:
        if v is not None and t in "PS":
            groups[k, p][t].append(v)
    assert got == {g: tuple(" | ".join(sorted(kinds[t])) or None for t in "PS") for g, kinds in groups.items()}


def test_ordered_text_ships_one_row_per_distinct_value(spark):
    frame = spark.range(10_000).select(F.lit("k").alias("k"), (F.col("id") % 3).cast("string").alias("v"), F.lit("P").alias("t"))
    out = agg.ordered_text(frame, ["k"], "v", "t", {"P": "texto"})
    assert Counter(out.first()["texto"].split(" | ")) == {"0": 3334, "1": 3333, "2": 3333}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2


def test_shares_sum_and_order(spark):
    frame = spark.createDataFrame([(v,) for v in "aaabbc"] + [(None,)], "v string")
    assert [tuple(r) for r in agg.shares(frame, "v").collect()] == [("a", 3, 42.86), ("b", 2, 28.57), ("c", 1, 14.29), (None, 1, 14.29)]
    assert agg.shares(frame.limit(0), "v").collect() == []


def test_counts_and_duplicates(spark):
    frame = spark.createDataFrame([("b", 1), ("a", 1), ("b", 1), (None, 1)], "v string, n int")
    assert [tuple(r) for r in agg.value_counts(frame, "v").collect()] == [("a", 1), ("b", 2), (None, 1)]
    assert [r.v for r in agg.distinct_values(frame, "v").collect()] == ["a", "b", None]
    assert [tuple(r) for r in agg.duplicate_keys(frame, ["v", "n"]).collect()] == [("b", 1, 2)]


def test_profiles_take_one_pass(spark):
    frame = spark.createDataFrame([(1, None), (5, "x"), (None, "y")], "`n.n` int, t string")
    profile = agg.null_profile(frame)
    assert [tuple(r) for r in profile.collect()] == [("n.n", 1, 3, 33.33), ("t", 1, 3, 33.33)]
    assert profile._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert [tuple(r) for r in agg.range_profile(frame, {"n.n": 2}, {"n.n": 4}).collect()] == [("n.n", 1.0, 5.0, 1, 1)]
    empty = agg.null_profile(frame.limit(0))
    assert [tuple(r) for r in empty.collect()] == [("n.n", 0, 0, 0.0), ("t", 0, 0, 0.0)]


def test_flags_count_only_true(spark):
    frame = spark.createDataFrame([(True,), (False,), (None,), (True,)], "f boolean")
    assert [tuple(r) for r in agg.flag_profile(frame, ["f"]).collect()] == [("f", 2, 4, 50.0)]


def test_invalid_values_sample_five_but_count_all(spark):
    rows = [(f"v{i % 9}", "ok") for i in range(90)] + [("ok", "bad"), (None, None)]
    frame = spark.createDataFrame(rows, "a string, b string")
    got = {r.columna: (r.cantidad, r.distintos, r.ejemplos) for r in agg.invalid_values(frame, {"a": ["ok"], "b": ["ok"]}).collect()}
    assert got == {"a": (90, 9, "v0, v1, v2, v3, v4"), "b": (1, 1, "bad")}


def test_any_repeated_deals_keys_to_as_many_tasks_as_they_take(spark, monkeypatch):
    monkeypatch.setattr(agg, "KEYS_PER_TASK", 10)
    dealt = []
    whole = agg.duplicate_keys
    monkeypatch.setattr(agg, "duplicate_keys", lambda df, keys: dealt.append(df.rdd.getNumPartitions()) or whole(df, keys))
    frame = spark.range(95).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("a.b"), F.lit(1).alias("x"))
    assert not agg.any_repeated(frame, ["a.b"])  # null keys repeat, and don't count
    assert agg.any_repeated(frame.unionAll(frame.limit(2)), ["a.b"])
    assert dealt == [10, 10]
    assert not agg.any_repeated(frame.limit(0), ["a.b"])
