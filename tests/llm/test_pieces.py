import hashlib
import random

import pytest
import sentencepiece

from padron.llm import pieces

MODEL = pieces.path_of()
ODD = ["", " ", "  a  b ", "\n\na\tb", "▁x", "x▁ y", "<s>x</s>", "<0x41>", "\x00a", "😀 ñ", "a" * 700, "ab" * 400, "=" * 333, " " * 99, "的a的", "aaab " * 50]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def samples():
    rng = random.Random(5)
    alphabet = "abcdeé ñ▁ \n\t的😀\x00ﬁaaaabbb  .,!<>/0x\xa0"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]


def test_ids_and_decoded_text_are_the_library_s(spark, documents, library):
    texts = samples()
    rows = {r["doc_id"]: r for r in pieces.encode(documents([*texts, None]), MODEL).collect()}
    for i, t in enumerate([*texts, ""]):
        want = [*library.encode(t), library.eos_id()]
        assert list(rows[i]["ids"]) == want and rows[i]["n_tokens"] == len(want)
        assert rows[i]["decoded"] == library.decode(want)


def test_digests_match_the_lists(spark, documents, library):
    docs = documents([*samples(), None, (7, "again", "s"), (None, "no id", "s")]).withColumnRenamed("lang", "ids_sha256")
    found = pieces.digests(docs, MODEL).collect()
    assert len(found) == docs.count()
    by_text = {(r["doc_id"], r["ids_sha256"]) for r in found}
    want = [*library.encode("again"), library.eos_id()]
    assert (7, hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()) in by_text


def test_merge_order_where_one_merge_is_not_safe(library):
    words = pieces.Vocabulary(MODEL)
    assert not words.safe.all()
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["in", "g", "the", "er", "e", "s", "t", "an"]) for _ in range(30))
        assert words.encode(text) == library.encode(text)


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    words = pieces.Vocabulary(MODEL)
    for text in ("one two three four five", "five six seven", "one two eight nine ten", "one"):
        assert words.encode(text) == library.encode(text)


def test_empty_table(spark, documents):
    assert pieces.digests(documents([]), MODEL).collect() == []
    assert pieces.encode(documents([]), MODEL).columns == ["doc_id", "n_tokens", "ids", "decoded"]
