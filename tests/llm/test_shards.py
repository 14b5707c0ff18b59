"""Sharding: exact sizes, laws of the matrix and of the permutations, defined cases."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from trackspark.llm import shards

from .helpers import documents


def test_hypergeometric_draws_follow_the_law():
    rng = np.random.Generator(np.random.PCG64(1))
    drawn = np.array([shards.hypergeometric(30, 50, 20, rng) for _ in range(20_000)])
    assert drawn.min() >= 0 and drawn.max() <= 20
    assert abs(drawn.mean() - 12) < 0.05 and abs(drawn.var() - 20 * 0.6 * 0.4 * 30 / 49) < 0.15
    assert [shards.hypergeometric(g, 9, d, rng) for g, d in ((0, 4), (9, 4), (5, 9), (5, 0))] == [0, 4, 5, 0]
    large = np.array([shards.hypergeometric(5 * 10**10, 10**11, 10**9, rng) for _ in range(200)])  # beyond 32 bits
    assert abs(large.mean() - 5 * 10**8) < 10**4 and 10**4 < large.std() < 2.2 * 10**4


def test_matrix_keeps_its_sums():
    counts = [5, 0, 17, 1, 40, 3, 0]
    matrix = shards.Matrix(counts, 7, 3)
    rows = [matrix.row(p) for p in range(len(counts))]
    assert [sum(sends) for sends, _ in rows] == counts
    assert tuple(map(sum, zip(*(sends for sends, _ in rows), strict=True))) == shards.shard_sizes(66, 7)
    before = np.zeros(7, int)
    for sends, offsets in rows:
        assert tuple(before) == offsets
        before += sends
    cell = [shards.Matrix([10, 10, 20], 4, seed).row(0)[0][2] for seed in range(3_000)]
    assert abs(np.mean(cell) - 2.5) < 0.08 and abs(np.var(cell) - 10 * 0.25 * 0.75 * 30 / 39) < 0.12


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1_000])
def test_permutations(n):
    assert sorted(shards.permuted(np.arange(n), n, [4, 5])) == list(range(n))
    if n == 3:  # all orders are equally likely
        seen = Counter(tuple(shards.permuted(np.arange(3), 3, [seed])) for seed in range(6_000))
        assert len(seen) == 6 and max(abs(c - 1_000) for c in seen.values()) < 150


def test_shards_of_a_table(spark):
    texts = [None, "", "é", "x" * 300_000, *["same"] * 70, *(f"t{i}" for i in range(128))]
    df = documents(spark, texts).selectExpr("*", "'mine' as slot", "3 as law").repartition(5)
    df = df.unionByName(df.filter("doc_id = 7"))
    got = shards.shuffle_to_shards(df, shards=16, seed=5).collect()
    assert sorted(map(tuple, (r[:-2] for r in got)), key=repr) == sorted(map(tuple, df.drop("slot").collect()), key=repr)
    held = {}
    for r in got:
        held.setdefault(r.shard, []).append(r.slot)
    assert set(held) == set(range(16)) and {len(v) for v in held.values()} == {12, 13}
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    for part in shards.shuffle_to_shards(df, 16, 5).select("shard", "slot").rdd.glom().collect():
        assert part == sorted(part)


def test_reruns_agree_and_seeds_differ(spark):
    df = documents(spark, [str(i) for i in range(90)])
    place = lambda seed: sorted((r.doc_id, r.shard, r.slot) for r in shards.shuffle_to_shards(df, 4, seed).collect())
    assert place(1) == place(1) != place(2)


def test_few_rows_and_none(spark):
    df = documents(spark, ["a", "b"])
    assert sorted((r.shard, r.slot) for r in shards.shuffle_to_shards(df, 16).collect()) == [(0, 0), (1, 0)]
    none = shards.shuffle_to_shards(df.limit(0), 16)
    assert none.collect() == [] and none.columns[-2:] == ["shard", "slot"]


def test_query_columns(spark, tmp_path):
    documents(spark, [None, "é", "ab"]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in shards.op11_shard_shuffle(spark, str(tmp_path)).collect()}
    assert [(got[i]["size"], got[i].text_crc32) for i in range(3)] == [(len(t) + 1, zlib.crc32(t)) for t in (b"", "é".encode(), b"ab")]
    assert {(r.law, r.grown_shard) for r in got.values()} == {("rows", None)}


def test_a_shard_is_a_uniform_sample(spark):
    """Rows that are neighbours in the input are spread over shards: counts per (input part, shard) are close to even."""
    df = spark.range(0, 16_000, numPartitions=4).withColumn("part", F.spark_partition_id())
    cells = shards.shuffle_to_shards(df, 4, 9).groupBy("part", "shard").count().collect()
    assert len(cells) == 16 and all(abs(r["count"] - 1_000) < 150 for r in cells)
    slots = shards.shuffle_to_shards(df, 4, 9).filter("slot < 1000").groupBy("part").count().collect()
    assert all(abs(r["count"] - 1_000) < 150 for r in slots)
