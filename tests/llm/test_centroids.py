"""Lloyd's rounds by blocks of dimensions against plain numpy; defined cases."""

import hashlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from trackspark.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def lloyd(rows, clusters, rounds, dims, scale=1024, seed=3):
    kept = [(i, np.floor(scale * np.array(x, np.float64)).astype(np.int64)) for i, x in rows
            if x is not None and len(x) == dims and all(v is not None and np.isfinite(v) for v in x)]
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), list(r[1])))
    c, x = np.stack([r[1] for r in first[:clusters]]), np.stack([r[1] for r in kept])

    def nearest():
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        label, _ = nearest()
        for k in range(len(c)):
            if (label == k).any():
                c[k] = np.floor_divide(x[label == k].sum(0), (label == k).sum())
    label, d = nearest()
    sha = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c]
    return [(i, int(k), int(v), int(d[label == k].sum()), int(d.sum()), sha[k]) for (i, _), k, v in zip(kept, label, d, strict=True)]


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, x, 1) for i, x in rows], SCHEMA)
    return sorted((tuple(r) for r in centroids.with_inertia(*centroids.cluster_vectors(frame, **options)).collect()), key=repr)


@pytest.mark.parametrize(("width", "chunk"), [(2, 7), (4, 100), (3, 1)])
def test_equals_plain_rounds(spark, width, chunk):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(i % 3, 0.4, 5)]) for i in range(60)]
    rows += [(100, None), (101, [1.0] * 4), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [float("nan")] + [0.0] * 4),
             (104, [float("inf")] + [0.0] * 4), (None, [0.5] * 5), (7, rows[7][1]), (8, rows[9][1])]
    assert run(spark, rows, clusters=4, rounds=3, dims=5, width=width, chunk=chunk) == sorted(lloyd(rows, 4, 3, 5), key=repr)


def test_ties_equal_vectors_and_few_vectors(spark):
    same = [(i, [1.0, 2.0]) for i in range(6)]
    got = run(spark, same, clusters=3, rounds=2, dims=2, width=1)
    assert got == sorted(lloyd(same, 3, 2, 2), key=repr) and {r[1] for r in got} == {0}  # a tie goes to the smaller number
    few = [(1, [0.0, 0.0]), (2, [3.0, 4.0])]
    assert run(spark, few, clusters=8, rounds=2, dims=2) == sorted(lloyd(few, 8, 2, 2), key=repr)
    assert run(spark, [(1, None)], dims=2) == []
    assert spark.sql("show tables").filter("tableName like 'trackspark_blocks%'").count() == 0


def test_too_large_components_raise(spark):
    with pytest.raises(PySparkException, match="too large"):
        run(spark, [(1, [1e30, 0.0])], dims=2)


def test_vectors_stay_where_they_are(spark):
    """A round shuffles labels and distances: the blocks are joined by their buckets."""
    frame = spark.createDataFrame([(i, [float(i % 7), 1.0, 2.0, float(i)], 0) for i in range(50)], SCHEMA)
    plans, move = [], centroids.move

    def seen(blocks, labels, *rest):
        sent = labels.selectExpr("chunk", "labels", "explode(array(0, 1)) as block")
        plans.append(blocks.filter("block >= 0").join(sent.hint("merge"), ["block", "chunk"])._jdf.queryExecution().executedPlan().toString())
        return move(blocks, labels, *rest)

    centroids.move = seen
    try:
        centroids.cluster_vectors(frame, clusters=2, rounds=1, dims=4, width=2)
    finally:
        centroids.move = move
    initial = plans[0]
    assert initial.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in initial
