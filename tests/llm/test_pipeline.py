import random

from pyspark.sql import functions as F

import corpus_pipeline
from padron.llm.common import read, stored
from padron.llm.queries import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_keeps_the_columns_and_takes_effect(spark):
    docs = read(spark, FOLDER, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, FOLDER), f"test-{name}")
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
        if name == "line_dedup":
            assert after.count() == before.count()
        before = after
    rows = corpus_pipeline.encoded(spark, before, FOLDER).collect()
    assert len(rows) == before.count() and all(r["ids"][-1] == 2 for r in rows)
    assert sorted(r["decoded"] for r in rows) == sorted(r["text"] or "" for r in before.collect())


def test_names():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "encoding"]
    assert {n.split("_")[0] for n in queries()} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(oracle_sql()) <= set(queries())


def odd_folder(spark, tmp_path, documents, labels, rows):
    folder = str(tmp_path / "odd")
    documents(rows).withColumn("extra", F.lit(1)).withColumn("group", F.lit("clash")).write.parquet(f"{folder}/documents.parquet")
    labels([(i, 1, 0) for i in range(0, 20, 3)] + [(None, 1, 1)]).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_nulls_repeats_long_texts_and_extra_columns(spark, tmp_path, documents, labels):
    rng = random.Random(7)
    rows = [(i, "\n".join(" ".join(rng.choices(["one", "two", "three", "Étion", "word"], k=9)) for _ in range(6)), rng.choice(["a", "b", None])) for i in range(30)]
    rows += [(3, rows[3][1], "a"), (40, None, "a"), (41, "", "b"), (42, " \n\t", None), (None, "a text without an id", "a"), (43, "w " * 200_000, "b"), (44, rows[0][1], "b")]
    folder = odd_folder(spark, tmp_path, documents, labels, rows)
    before = read(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, folder), f"odd-{name}")
        assert after.columns == corpus_pipeline.COLUMNS  # extra columns go
        if name == "line_dedup":  # a whole copy has nothing left of its own
            assert {r["text"] for r in after.filter("doc_id = 44").collect()} == {""}
        if name == "near_dedup":  # of the documents without a word the first stays
            left = {r["doc_id"] for r in after.collect()}
            assert left <= {r[0] for r in rows} and 40 in left and not {41, 42, 44} & left
        before = after
    assert {r["doc_id"] for r in before.collect()} <= {r[0] for r in rows}
    assert len(corpus_pipeline.encoded(spark, before, folder).collect()) == before.count()


def test_an_empty_table(spark, tmp_path, documents, labels):
    folder = odd_folder(spark, tmp_path, documents, labels, [])
    assert corpus_pipeline.run(spark, folder).collect() == []
