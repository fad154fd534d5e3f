import random
import re

import numpy as np
from pyspark.sql import functions as F

from padron.llm import passages


def words(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def corpus():
    rng = random.Random(8)
    shared = [words(rng, n) for n in (52, 60, 90, 300)]
    texts = [None, "", "a b c", " ".join(words(rng, 49))]
    for i in range(80):
        own = words(rng, rng.randint(60, 200))
        for p in [rng.choice(shared)] if i % 2 else []:
            at = rng.randint(0, len(own))
            own[at:at] = p
        texts.append(" ".join(own))
    near = list(shared[3])
    for at in range(0, 300, 60):
        near[at] = "edited"
    texts.append(" ".join(words(rng, 80) + near + words(rng, 30)))
    texts += [texts[10], texts[10], texts[11].upper()]
    return texts


def test_every_text_that_shares_fifty_words_is_found(documents):
    texts = corpus()
    found = passages.repeated_passages(documents(texts).withColumn("doc", F.lit(1)).withColumn("whole", F.lit("x"))).collect()
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for i, t in enumerate(texts)}
    seen = {}
    for i, w in tokens.items():
        for k in range(len(w) - 49):
            seen.setdefault(tuple(w[k : k + 50]), set()).add(i)
    shared = {i for s in seen.values() if len(s) > 1 for i in s}
    near = next(i for i, t in enumerate(texts) if t and "edited" in t)
    assert {r["doc_id"] for r in found} == shared | {near}
    for r in found:
        own = tokens[r["doc_id"]][r["start_word"] : r["start_word"] + r["n_words"]]
        assert len(own) == r["n_words"] >= 50 and r["twin_id"] != r["doc_id"] and r["similarity"] >= 0.8
    whole = {(r["doc_id"], r["twin_id"]) for r in found if r["whole"]}
    first = len(texts) - 3
    assert (first, 10) in whole and (first + 1, 10) in whole and (10, first) in whole


def test_phrases_that_recur_inside_and_outside_do_not_cut_a_passage():
    ids = iter(range(10**6))

    def fresh(n):
        return [next(ids) for _ in range(n)]

    def found(one, two):
        left, right = (passages.mix(np.array(x, np.uint64)) for x in (one, two))
        return passages.passages(left, right, np.array([len(one) - 5]), np.array([len(two) - 5]))

    phrase, start, middle, end = fresh(6), fresh(10), fresh(22), fresh(16)
    inside = start + phrase + middle + phrase + end  # 60 words, the phrase is in it twice
    plain = start + phrase + middle + end + fresh(6)
    before, after = fresh(30), fresh(30)
    assert found(before + inside + after, fresh(20) + inside + fresh(9)) == [(30, 60, 20, 60, 1.0)]
    assert found(before + plain + after, fresh(9) + phrase + fresh(14) + plain) == [(30, 60, 29, 60, 1.0)]
    assert found(fresh(9) + phrase + fresh(14) + plain, before + plain + after) == [(29, 60, 30, 60, 1.0)]
    refrain = [w for _ in range(9) for w in fresh(34) + phrase]
    assert found(before + refrain + after, fresh(8) + refrain + after[::-1]) == [(30, 360, 8, 360, 1.0)]
    # Twice in the second text: both places are told.
    assert {(r[0], r[2]) for r in found(before + plain, plain + fresh(20) + plain)} == {(30, 0), (30, 80)}
    # A text that repeats itself does not give each shift of a passage.
    cycle = [w for _ in range(60) for w in phrase]
    assert len(found(cycle, cycle[3:])) == 1
    # One word over and over is one passage of all of it, and needs no list of all pairs.
    assert found([7] * 30_000, [7] * 30_000)[0][:4] == (0, 30_000, 0, 30_000)


def test_windows_are_those_of_the_cartesian_tree():
    rng = np.random.default_rng(0)
    tokens, offs = rng.integers(0, 2**63, 300).astype(np.uint64), np.array([0, 120, 130, 300])
    key, row, first, last = passages.compact_windows(tokens, offs, 20)
    for k, r, a, b in list(zip(key, row, first, last, strict=True))[:200]:
        own = tokens[offs[r] : offs[r + 1]]
        for band in range(passages.BANDS):
            least = [(own * passages._TIMES[2 * band + j]) for j in range(2)]
            keys = {
                tuple(int(x[s : s + n].min()) for x in least)
                for s in range(a, b - 20 + 2) for n in {20} if s + n <= b + 1
            }
            made = {int(passages.mix(np.uint64(x[0]) * np.uint64(2 * band + 3) + passages.mix(np.array([x[1]], np.uint64)))[0]) for x in keys}
            if int(k) in made:
                assert len(keys) == 1  # one signature in the whole window
                break
        else:
            raise AssertionError("no band has this key")


def test_running_minima():
    x = np.random.default_rng(1).integers(0, 100, 57)
    for width in (1, 2, 3, 8, 13, 40):
        assert passages.running_minima(x, width).tolist() == [x[i : i + width].min() for i in range(len(x) - width + 1)]


def test_one_passage_in_very_many_texts_costs_few_links(documents):
    rng = random.Random(3)
    common = words(rng, 70)
    docs = documents([" ".join(words(rng, 20) + common + words(rng, 20)) for _ in range(150)])
    found = passages.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in found} == set(range(150)) and len(found) < 600


def test_null_ids_and_empty_table(documents):
    text = " ".join(f"w{i}" for i in range(60))
    found = passages.repeated_passages(documents([(1, text, "s"), (1, text, "s"), (None, text, "s")])).collect()
    assert found == []
    assert passages.repeated_passages(documents([])).collect() == []


def versions(n, step):
    """Texts that each differ from the one before by a word, in an order that mixes them."""
    rng = random.Random(5)
    now, out = words(rng, 90), []
    for i in range(n):
        now = [*now]
        now[i * step % 90] = f"v{i}"
        out.append(" ".join(now))
    rng.shuffle(out)
    return out


def test_versions_of_one_text_are_one_group(documents):
    texts = versions(60, 37)
    docs = documents([t for t in texts if t])
    for batch in (1, 7):
        found = passages.repeated_passages(docs.repartition(batch)).collect()
        assert {r["doc_id"] for r in found} == set(range(60))
        assert {r["group_id"] for r in found} == {0}


def test_a_pair_behind_an_unlike_first_is_found(documents):
    """Twenty texts share a short phrase and its keys; two of them, neither the first, share a passage around it."""
    rng = random.Random(11)
    phrase = words(rng, 30)
    texts = [words(rng, 60) + phrase + words(rng, 60) for _ in range(20)]
    for k in (4, 9, 15):
        texts[k][20:60], texts[k][90:110] = texts[4][20:60], texts[4][90:110]
    found = [r for r in passages.repeated_passages(documents([" ".join(t) for t in texts])).collect()]
    assert {r["doc_id"] for r in found} == {4, 9, 15} and {r["group_id"] for r in found} == {4}


def test_bounds_never_drop_what_is_similar_enough():
    """Stretches of 46 tokens or more that are similar enough by their sets pass both bounds, with repeated tokens too."""
    rng = np.random.default_rng(4)
    held = 0
    for kinds in (30, 10**6):
        for _ in range(60):
            base = rng.integers(0, kinds, 120)
            kept = rng.random(120) > 0.12
            ta, tb = base, np.where(kept, base, rng.integers(0, kinds, 120) + kinds)
            n, numbers = passages._numbered(ta, tb)
            one, two = numbers[:120], numbers[120:]
            at = np.flatnonzero(one == two)
            likeness = passages._Likeness(one, two, n)
            if list(passages._dense(one, two, at, at, n)):
                held += 1
                assert likeness.anywhere() and likeness.along(at, at)
    apart = passages._Likeness(np.arange(100), np.arange(100, 200), 200)
    assert held > 20 and not apart.anywhere()


def test_shuffle_files_of_a_stored_table_go_with_its_query(documents, monkeypatch):
    seen = []
    plain = passages._stored
    monkeypatch.setattr(passages, "_stored", lambda df, label: seen.append(df.sparkSession.conf.get(passages.CLEANUP)) or plain(df, label))
    docs = documents(["a b", "c d"])
    conf = docs.sparkSession.conf
    before = conf.get(passages.CLEANUP, None)
    assert passages.stored(docs.groupBy("doc_id").count(), "test-stored").count() == 2
    assert seen == ["true"] and conf.get(passages.CLEANUP, None) == before


def test_two_zones_meet_once(documents):
    docs = documents(["a"])
    pairs = docs.sparkSession.createDataFrame([(1, 5, 2, 6), (2, 6, 1, 5), (1, 5, 1, 9)], "doc bigint, span bigint, twin bigint, twin_span bigint")
    assert sorted(map(tuple, passages._once(pairs).collect())) == [(1, 9, 1, 5), (2, 6, 1, 5)]


def test_zones_are_compared_in_parts(documents, monkeypatch):
    """However many pairs the zones have, no more than some for each zone are shuffled at once; the pairs told are the same."""
    spark = documents(["a"]).sparkSession
    rows = [(i, 7, 2, [1, 2, 3, 40 + i] if i % 3 else [1, 2, 30 + i, 60 + i], [i // 6] * 4) for i in range(12)]
    zones = spark.createDataFrame(rows, "doc bigint, span bigint, spare int, tokens array<bigint>, groups array<bigint>")
    pairs = spark.createDataFrame([(i, 7, j, 7) for i in range(12) for j in range(i)], "doc bigint, span bigint, twin bigint, twin_span bigint")
    want = sorted((i, 7, j, 7) for i in range(6, 12) for j in range(6) if i % 3 and j % 3)
    sizes, plain = [], passages.stored

    def stored(df, label):
        out = plain(df, label)
        sizes.append((label, out.count()))
        return out

    monkeypatch.setattr(passages, "stored", stored)
    for per_side, parts in ((100, 1), (1, 6)):
        monkeypatch.setattr(passages, "PER_SIDE", per_side)
        sizes.clear()
        assert sorted(map(tuple, passages._alike(pairs, zones).collect())) == want
        assert [label for label, _ in sizes].count("passages-alike") == parts and sum(n for label, n in sizes if label == "passages-alike") == len(want)
    assert passages._alike(pairs.limit(0), zones.limit(0)).collect() == []


def test_texts_are_compared_in_parts(documents, monkeypatch):
    rng = random.Random(13)
    common = words(rng, 90)
    docs = documents([" ".join(words(rng, 30) + common + words(rng, 30)) for _ in range(9)])
    tokens = docs.select(F.col("doc_id").alias("doc"), "text").mapInArrow(passages._tokens, "doc bigint, tokens binary")
    span = (30 << 32) | 119
    links = docs.sparkSession.createDataFrame([(i, span, j, span) for i in range(9) for j in range(i)], "doc bigint, span bigint, twin bigint, twin_span bigint")
    labels, plain = [], passages.stored
    monkeypatch.setattr(passages, "stored", lambda df, label: labels.append(label) or plain(df, label))
    for per_side, parts in ((100, 1), (1, 4)):
        monkeypatch.setattr(passages, "PER_SIDE", per_side)
        labels.clear()
        found = sorted(tuple(r) for r in passages._found(links, tokens).collect())
        assert found == sorted((i, 30, 90, j, 30, 90, 1.0) for i in range(9) for j in range(i))
        assert labels.count("passages-found") == parts


def test_passages_inside_another_one_are_not_held(documents):
    spark = documents(["a"]).sparkSession
    rows = [(1, 0, 90, 4), (1, 0, 60, 4), (1, 20, 50, 4), (1, 20, 70, 4), (1, 30, 61, 4), (1, 200, 50, 9), (2, 0, 50, 4)]
    groups = spark.createDataFrame(rows, "doc bigint, start int, n int, group bigint")
    held = {r["doc"]: sorted(map(tuple, r["held"])) for r in passages._held(groups).collect()}
    assert held == {1: [(0, 90, 4), (30, 61, 4), (200, 50, 9)], 2: [(0, 50, 4)]}


def test_stretches_around_links_keep_their_places(documents):
    """Both texts come cut to what lies around the links; places are those of the whole texts, wherever the passage stands."""
    rng = random.Random(21)
    common = words(rng, 80)
    texts = [words(rng, 700) + common + words(rng, 400), words(rng, 3) + common + words(rng, 900), words(rng, 1500) + common]
    found = passages.repeated_passages(documents([" ".join(t) for t in texts])).collect()
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in found} == {(0, 700, 80), (1, 3, 80), (2, 1500, 80)}
    # No token comes to the comparison that lies further from the links than it looks.
    left, right = (np.arange(n, dtype=np.uint64) for n in (1180, 983))
    right[3:79] = left[700:776]
    ends = np.array([(700 << 32) | 779]), np.array([(3 << 32) | 82])
    whole = passages._shared(left, right, *ends)
    cut = passages._shared(left[636:845], right[:148], ends[0] - ((636 << 32) | 636), ends[1])
    assert whole == [(x[0] + 636, *x[1:]) for x in cut] == [(700, 80, 3, 80, 1.0)]
