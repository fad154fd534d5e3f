import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (doc_id, text, source)."""

    def make(rows, start=0):
        full = []
        for i, r in enumerate(rows):
            key, text, source = r if isinstance(r, tuple) else (i + start, r, "s")
            full.append((key, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")

    return make
