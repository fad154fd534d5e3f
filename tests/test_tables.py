"""Published tables: whichever step a run ends at, a whole table can be read, and the next run goes on from there."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from padron.sources import sinks, tables
from padron.sources.tables import Files


class Lost(BaseException):
    """The driver is gone: nothing after this line runs, not even handlers of errors."""


STEPS = ("rename", "delete", "make_folder", "create")


def ending_at(monkeypatch, step, copies=False):
    """File steps that end the run ahead of the given one; ``copies`` makes a rename a copy and a deletion, file by file."""
    left = [step]

    def tick():
        left[0] -= 1
        if left[0] < 0:
            raise Lost

    def counted(name):
        own = getattr(Files, name)

        def run(self, *args):
            tick()
            return own(self, *args)

        return run

    def copied(self, old, new):
        files = sorted(f for f in Path(old).rglob("*") if f.is_file())
        for f in files:
            tick()
            target = Path(new) / f.relative_to(old)
            target.parent.mkdir(parents=True, exist_ok=True)
            shutil.copy(f, target)
        for f in files:
            tick()
            f.unlink()
        shutil.rmtree(old)

    for name in STEPS:
        monkeypatch.setattr(Files, name, copied if copies and name == "rename" else counted(name))
    return left


def ids(spark, path):
    return sorted(r["id"] for r in tables.read(spark, path).collect())


@pytest.mark.parametrize("copies", [False, True])
def test_a_run_that_ends_at_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch, copies):
    old, new = list(range(20)), list(range(100, 120))
    frame = {0: spark.range(20).repartition(2), 1: spark.range(100, 120).repartition(2)}
    step = seen_new = 0
    while True:
        path = str(tmp_path / f"{copies}-{step}" / "t")
        sinks.write_current(frame[0], path)
        with monkeypatch.context() as m:
            left = ending_at(m, step, copies)
            try:
                sinks.write_current(frame[1], path)
            except Lost:
                pass
        done = left[0] >= 0
        found = ids(spark, path)
        assert found in (old, new), step
        assert not seen_new or found == new or not done
        tables.recover(spark, path, grace_hours=0)
        assert ids(spark, path) == found
        assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == found  # plain readers, after recovery
        assert [p.name for p in Path(path).parent.iterdir() if not p.name.startswith(".")] == ["t"]
        sinks.write_current(spark.range(3), path)
        assert ids(spark, path) == [0, 1, 2]
        step += 1
        if done:
            assert found == new
            break
    assert step > 4


def test_a_versioned_run_that_ends_at_any_step(spark, tmp_path, monkeypatch):
    step = 0
    while True:
        base = str(tmp_path / str(step))
        paths = sinks.write_versioned(spark.range(4), base, "t", "2024-01-01T00-00-00")
        with monkeypatch.context() as m:
            left = ending_at(m, step, copies=step % 2 == 0)
            try:
                sinks.write_versioned(spark.range(7), base, "t", "2024-01-02T00-00-00")
            except Lost:
                pass
        assert ids(spark, paths["actual"]) in (list(range(4)), list(range(7)))
        assert ids(spark, paths["historico"]) == list(range(4))
        again = sinks.write_versioned(spark.range(2), base, "t", "2024-01-03T00-00-00")
        assert ids(spark, again["actual"]) == ids(spark, again["historico"]) == [0, 1]
        assert spark.read.parquet(again["actual"]).count() == 2
        step += 1
        if left[0] >= 0:
            break
    assert step > 8


def test_manifests_are_never_replaced_and_broken_ones_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 4, 5, 6):
        sinks.write_current(spark.range(n), path)
    folder = Path(tables.commits_folder(path))
    names = sorted(p.name for p in folder.glob("*.json"))
    assert len(names) == tables.KEPT + 1 and tables.current(spark, path).number == 4
    assert Files(spark, path).create(f"{folder}/{names[-1]}", "x") is False
    (folder / f"{9:020}.json").write_text(tables.current(spark, path).text()[:-30])
    assert tables.current(spark, path).number == 4
    sinks.write_current(spark.range(8), path)
    assert tables.current(spark, path).number == 10 and len(ids(spark, path)) == 8


def test_tables_without_manifest_and_damaged_tables(spark, tmp_path):
    plain = str(tmp_path / "plain")
    spark.range(2).write.parquet(plain)
    assert ids(spark, plain) == [0, 1] and tables.current(spark, plain) is None and tables.metrics(spark, plain) == {}
    with pytest.raises(FileNotFoundError):
        tables.read(spark, str(tmp_path / "none"))
    sinks.write_current(spark.range(9).repartition(3), plain)
    next(p for p in Path(plain).glob("part-*")).unlink()
    with pytest.raises(tables.TableError):
        tables.read(spark, plain)
    with pytest.raises(FileNotFoundError):
        sinks.missing_outputs(spark, {"t": plain})


def test_leftovers_go_only_after_their_time(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_current(spark.range(1), path)
    running = sinks.stage(spark.range(5), path)
    tables.recover(spark, path)
    assert running.read().count() == 5
    tables.recover(spark, path, grace_hours=0)
    assert not Path(running.folder).exists() and ids(spark, path) == [0]


def test_what_is_observed_stays_with_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(100).withColumn("x", F.when(F.col("id") % 4 > 0, F.col("id")))
    sinks.write_current(frame, path, partition_by=["x"], observe={"nulos: x": F.count_if(F.col("x").isNull())})
    assert tables.metrics(spark, path) == {"filas": 100, "nulos: x": 25}


def file_ends(spark, folder, column):
    rows = spark.read.parquet(folder).select(F.col("_metadata.file_name").alias("f"), column)
    return [(r["lo"], r["hi"]) for r in rows.groupBy("f").agg(F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy("f").collect()]


@pytest.fixture
def many_files(spark):
    """Small tables keep the number of their partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_both_copies_keep_the_order(spark, tmp_path, many_files):
    frame = spark.range(0, 50_000, 1, 7).select(F.xxhash64("id").alias("k"), "id")
    paths = sinks.write_versioned(frame, str(tmp_path), "t", order=[F.col("k").asc_nulls_last()])
    for folder in paths.values():
        ends = file_ends(spark, folder, "k")
        assert len(ends) > 2 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))
    sinks.check_order(spark, paths["actual"], [F.col("k").asc_nulls_last()])
    with pytest.raises(sinks.OrderError):
        sinks.check_order(spark, paths["actual"], [F.col("id").asc()])
    empty = sinks.write_versioned(frame.limit(0), str(tmp_path), "e", order=[F.col("k").desc_nulls_last()])
    assert ids(spark, empty["actual"]) == []


def test_branches_are_one_pass_and_empty_ones_are_not_published(spark, tmp_path):
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    rows = spark.range(0, 60, 1, 3).withColumn("m", F.when(F.col("id") % 6 > 0, F.col("id") % 3))
    watched = rows.mapInArrow(count, rows.schema)
    m = F.col("m")
    paths = sinks.write_branches(watched, {"zero": m == 0, "big": F.col("id") >= 50, "none": m == 9}, str(tmp_path), "s")
    assert passed.value == 60
    assert list(paths) == ["zero", "big"]
    for name, want in (("zero", [i for i in range(60) if i % 6 and i % 3 == 0]), ("big", list(range(50, 60)))):
        for copy in paths[name].values():
            assert ids(spark, copy) == want and tables.read(spark, copy).columns == ["id", "m"]
        assert tables.metrics(spark, paths[name]["actual"])["filas"] == len(want)
    assert sorted(p.name for p in (tmp_path / "historico").iterdir() if not p.name.startswith(".")) == ["big", "zero"]


def test_branches_are_written_without_sorting(spark, tmp_path, monkeypatch):
    """A task keeps a file of each branch open; the setting that lets it holds for that write only."""
    seen, write = [], DataFrameWriter.parquet

    def watched(self, path, *args, **more):
        seen.append(spark.conf.get(sinks.WRITERS))
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    before = spark.conf.get(sinks.WRITERS)
    m = F.col("id") % 2
    paths = sinks.write_branches(spark.range(100), {"even": m == 0, "odd": m == 1}, str(tmp_path), "s")
    assert seen[0] == "2" and set(seen[1:]) == {before} and spark.conf.get(sinks.WRITERS) == before
    assert sorted(r[0] for r in tables.read(spark, paths["odd"]["actual"]).collect()) == list(range(1, 100, 2))
