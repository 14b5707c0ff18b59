import random

import numpy as np
import pytest
from trackspark.llm import topk


@pytest.mark.parametrize("block", [4, 1000])
def test_equals_brute_force(spark, block):
    """Ties, repeated rows and ids, nulls, non-finite values, other lengths."""
    pick = random.Random(1)
    rows = [(i, [pick.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(6)], 1) for i in range(120)]
    rows += [(7, rows[7][1], 1), (200, rows[3][1], 1), (300, None, 1), (None, rows[1][1], 1), (400, [1.0, None] * 3, 1),
             (401, [float("nan")] * 6, 1), (402, [float("inf")] * 6, 1), (403, [9.0] * 5, 1), (404, [0.0] * 6, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    v = topk.usable(df, "vec_id", "embedding")
    got = topk.top_k(v.filter("id % 10 = 0"), v, pivots=5, sample=40, query_block=block, candidate_block=block).collect()
    good = [(i, np.floor(256 * np.array(x, float)).astype(int)) for i, x, _ in rows
            if i is not None and x and None not in x and len(x) == 6 and np.isfinite(x).all()]
    want = []
    for q, x in {i: x for i, x in good if i % 10 == 0}.items():
        best = sorted((-int(x @ y), i) for i, y in good if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_few_candidates_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "id long, v array<double>").selectExpr("id", "cast(v as array<bigint>) v")
    assert [tuple(r) for r in topk.top_k(df.filter("id = 0"), df).collect()] == [(0, 1, 1, 2)]
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_bounds_leave_out_candidates():
    """Far from the origin, most of a block is never evaluated."""
    pick = np.random.Generator(np.random.PCG64(3))
    x = np.concatenate([pick.normal(0, 1, (2000, 8)), pick.normal(30, 1, (40, 8))]).round()
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    q = x[-1:].copy()
    pivots = x[[0, 2005, 100]]
    order = np.argsort(np.arange(len(x)))
    to_q, to_x = topk._distances(q, pivots), topk._distances(x, pivots)
    found = topk._search(q, np.array([-1]), to_q, x[order].view(Counted), np.arange(len(x)), to_x, 5)
    assert sorted(found[2]) == sorted(np.sort(x @ q[0])[-5:])
    assert topk.STEP <= sum(seen) <= len(x) // 4
