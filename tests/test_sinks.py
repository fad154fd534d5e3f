import pytest
from pyspark.sql import functions as F

from padron.session import shared_folder
from padron.sources import sinks


def test_versions_agree_and_history_grows(spark, tmp_path):
    base = str(tmp_path)
    first = spark.range(5).withColumn("r", F.rand())
    paths = sinks.write_versioned(first, base, "t", "2024-01-01T00-00-00")
    current = sorted(map(tuple, spark.read.parquet(paths["actual"]).collect()))
    assert current == sorted(map(tuple, spark.read.parquet(paths["historico"]).collect()))
    sinks.write_versioned(spark.range(2), base, "t", "2024-01-02T00-00-00")
    assert spark.read.parquet(paths["actual"]).count() == 2
    history = spark.read.option("mergeSchema", True).parquet(f"{base}/historico/t")
    assert history.groupBy(F.col("run_ts").cast("string")).count().count() == 2


def test_empty_branches_are_not_written(spark, tmp_path):
    paths = sinks.write_split({"a": spark.range(1), "b": spark.range(0)}, str(tmp_path), "x")
    assert list(paths) == ["a"]
    assert not (tmp_path / "actual" / "b").exists()


def test_partitioned_output_keeps_types_and_prunes(spark, tmp_path):
    frame = spark.createDataFrame([("2024-01", 1, "007"), ("2024-02", 2, "008")], "PERIODO string, n int, `d.d` string")
    stored = sinks.write_current(frame, str(tmp_path / "t"), "zstd", ["PERIODO"])
    assert dict(stored.dtypes) == {"PERIODO": "string", "n": "int", "d.d": "string"}
    one = stored.filter("PERIODO = '2024-01'")
    assert [r["d.d"] for r in one.collect()] == ["007"]
    assert "PartitionFilters: [isnotnull(PERIODO" in one._jdf.queryExecution().executedPlan().toString()
    assert any(p.name.endswith(".zstd.parquet") for p in (tmp_path / "t").rglob("*.parquet"))


def test_review_extract_has_dates_as_text(spark, tmp_path):
    frame = spark.createDataFrame([("a", "2024-01-02")], "`x.y` string, d string").withColumn("d", F.to_date("d"))
    assert sinks.review_frame(frame).dtypes == [("x.y", "string"), ("d", "string")]
    sinks.write_review(frame, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first()["d"] == "2024-01-02"


def test_output_check(spark, tmp_path):
    there = str(tmp_path / "t")
    spark.range(1).write.parquet(there)
    gone = str(tmp_path / "gone")
    assert sinks.missing_outputs(spark, {"t": there}, {"g": gone}) == ["g"]
    with pytest.raises(FileNotFoundError, match="g"):
        sinks.missing_outputs(spark, {"g": gone})


def test_shared_folder_is_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a.startswith(base) and a != b


def test_a_failed_write_keeps_the_previous_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_current(spark.range(3), path)
    bad = spark.range(5).selectExpr("CASE WHEN id = 4 THEN raise_error('no') ELSE id END AS id")
    with pytest.raises(Exception, match="no"):
        sinks.write_current(bad, path)
    with pytest.raises(FileNotFoundError):
        sinks.publish(spark, str(tmp_path / "absent"), path)
    assert spark.read.parquet(path).count() == 3
    sinks.write_current(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert not list(tmp_path.glob("t.old-*"))


def test_without_a_shared_folder_there_is_an_error():
    from padron.session import SHARED, use_local_folder

    class Conf(dict):
        set = dict.__setitem__

    class Context:
        master = "spark://cluster:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match=SHARED):
        shared_folder(use_local_folder(Session()), "x")
    Session.sparkContext.master = "local[4]"
    assert "padron-" in shared_folder(use_local_folder(Session()), "x")
    Session.sparkContext.master, Session.conf = "local-cluster[3,2,1024]", Conf()
    with pytest.raises(RuntimeError):
        shared_folder(use_local_folder(Session()), "x")
