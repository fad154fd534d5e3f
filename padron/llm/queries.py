"""One registered query per operator, over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from padron.llm import interactions, language, line_dedup, mixing, near_duplicates, passages, perplexity, pieces, repair, rules, topk, toxicity, wrappers
from padron.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, folder, "documents").select("doc_id", "text"))


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return topk.top_k(vectors, is_query=F.col("vec_id") % 20 == 0)


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_texts(read(spark, folder, "pages"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept", "anomaly")


def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(read(spark, folder, "documents"), width=4)


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(read(spark, folder, "documents"), pieces.path_of())


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(read(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("bigint").alias("n_passages"),
    )


def op11_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations")
    found = repair.summaries(repair.repair(repair.damaged(given)))
    every = given.select(F.col("conv_id").alias("_id")).distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = read(spark, folder, "documents"), language.held_out(F.col("doc_id"))
    found = language.identify(docs, language.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: A line goes if it lies in two neighbouring lines (blank ones between them aside) that an earlier place has.
OP1_SQL = r"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM s),
f AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS solid FROM l),
p AS (
  SELECT doc_id, i AS start, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM f WHERE solid
), b AS (
  SELECT p.doc_id, start, stop, array_to_string(lines[start:stop], chr(10)) AS body FROM p JOIN s USING (doc_id) WHERE stop IS NOT NULL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, start) > 1 AS again FROM b
), g AS (
  SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS i FROM r WHERE again
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text, count(*) AS n_lines, count(g.i) AS n_removed
  FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
) k USING (doc_id)
"""

OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS cells
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.cells) + 1), lambda i: q.cells[i] * c.cells[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.cells) = len(c.cells)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), f AS (
  SELECT doc_id, part,
         len(words) < 50 AS a,
         100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM t
), k AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), n AS (
  SELECT part,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: (x = 'A' AND a) OR (x = 'B' AND b) OR (x = 'C' AND c) OR (x = 'D' AND d) OR (x = 'E' AND e)) AS bad,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN k USING (doc_id) GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT p.f || q.f || r.f || s.f || u.f AS filter_order
  FROM x p, x q, x r, x s, x u
  WHERE len(list_distinct([p.f, q.f, r.f, s.f, u.f])) = 5
), s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, string_split(left(filter_order, step - 1), '') AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (NOT list_has_any(bad, before) AND NOT list_contains(bad, f)), 0) AS kept,
         coalesce(sum(n) FILTER (NOT list_has_any(bad, before) AND list_contains(bad, f)), 0) AS removed,
         coalesce(sum(n) FILTER (list_has_any(bad, before) AND list_contains(bad, f)), 0) AS redundant,
         coalesce(sum(n) FILTER (bad = [f]), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT list_has_any(bad, before) AND list_contains(bad, f)), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT list_has_any(bad, before) AND list_contains(bad, f)), 0) AS toxic_lost
  FROM n, s GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

#: All pairs of documents that share a shingle, by how many they share, and what is reachable over the links.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM w
), n AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles FROM s),
u AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n_shingles + y.n_shingles - shared)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS near FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.near)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept
FROM n JOIN (SELECT doc_id, min(near) AS component_id FROM r GROUP BY doc_id) USING (doc_id)
"""

#: ``z``, ``s``, ``u`` and ``a`` are the lightest edits so far that end before any turn, after a system, user or assistant turn.
OP12_SQL = r"""
WITH RECURSIVE g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), k AS (
  SELECT *, xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: 0::BIGINT)),
                                    lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS kind
  FROM g
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN CAST([] AS INTEGER[]) WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM d
), t AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS r,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM n
), l AS (
  SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM t
), f AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS turns
  FROM l GROUP BY conv_id
), w AS (
  SELECT conv_id, 0::BIGINT AS i, turns, {'c': 0, 'e': '', 'o': ''} AS z, {'c': 1000000000, 'e': '', 'o': ''} AS s,
         {'c': 2, 'e': 'I', 'o': chr(10) || 'user:'} AS u, {'c': 4, 'e': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'} AS a
  FROM f
  UNION ALL
  SELECT conv_id, i, turns, z, s, u,
         least(a, {'c': u.c + 2, 'e': u.e || 'I', 'o': u.o || chr(10) || 'assistant:'}) AS a
  FROM (
    SELECT conv_id, i, turns, z, s, a,
           least(u, {'c': z.c + 2, 'e': z.e || 'I', 'o': z.o || chr(10) || 'user:'},
                 {'c': s.c + 2, 'e': s.e || 'I', 'o': s.o || chr(10) || 'user:'},
                 {'c': a.c + 2, 'e': a.e || 'I', 'o': a.o || chr(10) || 'user:'}) AS u
    FROM (
      SELECT w.conv_id, t.i, w.turns,
             {'c': z.c + 3, 'e': z.e || 'D', 'o': z.o} AS z,
             least({'c': s.c + 3, 'e': s.e || 'D', 'o': s.o}, {'c': z.c + p.k + if(r = 's', 0, 1000000000), 'e': z.e || 'K', 'o': z.o || p.line}) AS s,
             least({'c': u.c + 3, 'e': u.e || 'D', 'o': u.o}, {'c': y.c + p.k + if(r = 'u', 0, 1000000000), 'e': y.e || 'K', 'o': y.o || p.line},
                   {'c': y.c + p.k + 2, 'e': y.e || 'R', 'o': y.o || chr(10) || 'user:' || text}) AS u,
             least({'c': a.c + 3, 'e': a.e || 'D', 'o': a.o}, {'c': u.c + p.k + if(r = 'a', 0, 1000000000), 'e': u.e || 'K', 'o': u.o || p.line},
                   {'c': u.c + p.k + 2, 'e': u.e || 'R', 'o': u.o || chr(10) || 'assistant:' || text}) AS a
      FROM (SELECT *, least(z, s, a) AS y FROM w) w
      JOIN (SELECT *, {'k': CASE fault WHEN 'truncated' THEN 1 WHEN '' THEN 0 ELSE 1000000000 END, 'line': chr(10) || role || ':' || text} AS p FROM t) t
        ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
    )
  )
), b AS (SELECT conv_id, least(z, a) AS best FROM w WHERE i = turns)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""

QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_topk": op2_topk,
    "op3_html_extraction": op3_html_extraction,
    "op4_quality_rules": op4_quality_rules,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_mixing": op6_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_language_id": op13_language_id,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op2_topk": OP2_SQL,
    "op5_minhash_dedup": OP5_SQL,
    "op11_filter_interactions": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
