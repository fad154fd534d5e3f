"""A training corpus from raw documents, in five stages; each stage's rows are stored and read again by the next.

Stages take and give the five columns of documents; others are left out. Rows without a text stay until a stage has a
reason to drop them, rows without an id are never compared by it, and repeated rows are treated alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm import line_dedup, mixing, near_duplicates, pieces, toxicity
from padron.llm.common import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is under one half.

    The model is learned from the labelled rows of the raw documents outside the held-out fold.
    """
    labels = read(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(read(spark, sf_dir, "documents"), labels)
    return toxicity.keep(docs.select(COLUMNS), model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the chunks of lines that an earlier place already has; ``n_chars`` follows the text."""
    cut = line_dedup.line_dedup(docs.select(COLUMNS))
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates (five words, 0.8).

    Documents without a word, as those of which the stage before has left nothing, are one group.
    """
    groups = stored(near_duplicates.near_duplicates(docs), "pipeline-groups")
    first = groups.filter("n_shingles = 0").agg(F.min("doc_id")).first()[0]
    wordless = (F.col("n_shingles") == 0) & (F.col("doc_id") > F.lit(first).cast("bigint"))
    gone = groups.filter(~F.col("kept") | F.coalesce(wordless, F.lit(False))).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target number of words: a document is repeated as often as the mix takes it."""
    return mixing.repeat(mixing.mix(docs.select(COLUMNS)), COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text they decode to."""
    return pieces.encode(docs, pieces.path_of())


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("mixing", mixed),
    ("encoding", encoded),
]
#: SQL can't say what the model, the signatures or the encoding do; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
