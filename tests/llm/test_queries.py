"""Every registered query has SQL, or a test that holds it against something else."""

from pathlib import Path

import pytest

from padron.llm.queries import oracle_sql, queries

#: For each query without SQL: the test that compares it with brute force, a library, or held-out rows.
HELD_BY = {
    "op3_html_extraction": "test_wrappers.py::test_whole_articles_of_the_given_pages",
    "op4_quality_rules": "test_rules.py::test_counts_are_those_of_the_whole_text",
    "op6_mixing": "test_mixing.py::test_targets_rates_and_copies",
    "op7_quality_classifier": "test_perplexity.py::test_same_as_a_plain_model",
    "op8_sentencepiece": "test_pieces.py::test_ids_and_decoded_text_are_the_library_s",
    "op9_substring_dedup": "test_passages.py::test_every_text_that_shares_fifty_words_is_found",
    "op10_toxicity": "test_toxicity.py::test_held_out_texts_are_told_apart",
    "op13_language_id": "test_language.py::test_predictions_equal_counting_in_dictionaries",
    "pipeline": "test_pipeline.py::test_every_stage_keeps_the_columns_and_takes_effect",
}


def test_every_query_is_held_by_something():
    assert set(queries()) == {*oracle_sql(), *HELD_BY} and not set(oracle_sql()) & set(HELD_BY)
    for where in HELD_BY.values():
        file, _, name = where.partition("::")
        source = (Path(__file__).parent / file).read_text()
        assert f"def {name}(" in source, where


@pytest.mark.parametrize("name", [n for n in HELD_BY if n != "pipeline"])
def test_queries_give_one_row_a_document_or_page(spark, name):
    folder = "/root/testdata/sf0.001"
    table = "pages" if name.startswith("op3_") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    want = sorted(r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect())
    found = sorted(r[0] for r in queries()[name](spark, folder).select(key).collect())
    assert set(found) <= set(want) if name.startswith("op9_") else found == want
