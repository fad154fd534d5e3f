import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from padron.llm.topk import top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    cells = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            cells.setdefault((i, tuple(math.floor(64 * float(np.float32(x))) for x in v)))
    out = []
    for q, a in cells:
        if q % every == 0:
            found = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in cells if i != q and len(a) == len(b)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def got(spark, rows, **sizes):
    found = top_k(spark.createDataFrame(rows, SCHEMA), is_query=F.col("vec_id") % 20 == 0, **sizes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("sizes", [{}, {"tile_queries": 2, "tile_shard": 3}])
def test_same_as_brute_force_with_ties_and_bad_rows(spark, sizes):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).round(1).tolist(), i % 3) for i in range(85)]
    rows[7] = (7, None, 1)
    rows[8] = (8, [1.0, None, 0.0, 0.0], None)
    rows[9] = (9, [1.0, float("nan"), 0.0, 0.0], 1)
    rows[10] = (10, [1.0, float("inf"), 0.0, 0.0], 1)
    rows[11] = (11, [0.5, 0.5], 1)
    rows += [rows[20], (None, [1.0] * 4, 1), (100, [0.25, 1.0], 0), (101, [], 0), (120, [], 0)]
    rows += [(200 + i, [1.0] * 4, 1) for i in range(30)]  # one very common vector
    assert got(spark, rows, **sizes) == brute(rows)


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(2.0**40 + i * 2.0**20), float(i)], 0) for i in (0, 1, 2, 20)]
    want = [(q, r, i, min(s, 2**63 - 1)) for q, r, i, s in brute(rows)]
    assert [x[3] for x in got(spark, rows)] == [x[3] for x in want]


def test_no_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 0)]) == []
