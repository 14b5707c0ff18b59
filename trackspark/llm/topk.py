"""Exact top-k inner products by pivot-table elimination.

Vectors become integers, floor(scale * x). For integer vectors 2 q.x = |q|^2 + |x|^2 - d(q, x)^2, so a lower bound of
the distance is an upper bound of the product. A table, computed once and landed beside the vectors, holds the distance of every vector to many pivots; the largest
|d(q, p) - d(x, p)| over the pivots bounds d(q, x) from below. Candidates are taken in order of their bound and
evaluated until the next bound is below the k-th best product found: no later candidate can enter. Equal bounds are
evaluated, so ties go to the smaller id exactly.

Pivots are fitted on a bounded sample of ``SAMPLE`` vectors, the vectors of least hash, by taking the
farthest from those taken so far; every vector is indexed. Vectors and queries travel in packed
blocks: queries in blocks of ``QUERY_BLOCK``, candidates in blocks near one pivot. Every candidate block meets every
query block, since the query set is stated and the answer exact; a block whose bounds all fail is not evaluated. A block
keeps k rows per query, which are merged by query id.

Defined cases: vectors that are null, hold a null or a non-finite component take no part, nor do rows with a null id;
vectors of another length than the most frequent one (ties: the shorter) take no part either. Rows of equal id are separate candidates; a query
id is answered once, by its vector of least bytes, and leaves out all rows of its own id. Products are exact while |x| * |q| stays
below 2^53. Fewer than k candidates give fewer rows. An empty table gives no rows. Other columns are not read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators.scratch import land

SCALE = 256
PIVOTS = 48
SAMPLE = 2_000
QUERY_BLOCK = 2_048
CANDIDATE_BLOCK = 4_096
STEP = 256  # candidates evaluated between two looks at the bounds

_PACKED = "block bigint, n int, ids binary, vectors binary, distances binary"


def usable(table, id_column, vector_column, scale=SCALE):
    """(id, v): integer vectors of the rows that take part."""
    whole = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = whole.filter(F.coalesce(good, F.lit(False)))
    return whole.select("id", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def fit_pivots(vectors, pivots=PIVOTS, sample=SAMPLE):
    """Pivots from a bounded sample, farthest first; float64 rows."""
    rows = vectors.orderBy(F.xxhash64("id", "v"), "id").limit(sample).select("v").collect()
    points = np.array([r[0] for r in rows], dtype=np.float64)
    if not len(points):
        return points
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(points)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _pack(key, ids, vectors, pivots):
    """One block with its part of the pivot table."""
    return pd.DataFrame({"block": [key], "n": [len(ids)], "ids": [np.asarray(ids, "<i8").tobytes()],
                         "vectors": [np.ascontiguousarray(vectors, "<i8").tobytes()],
                         "distances": [np.ascontiguousarray(_distances(np.asarray(vectors, np.float64), pivots), "<f8").tobytes()]})


def _blocks_by_pivot(pivots, size):
    """Pack each Arrow batch into blocks of vectors that share their nearest pivot."""
    def pack(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["v"].to_numpy()).astype(np.float64)
            order = np.argsort(_distances(x, pivots).argmin(1), kind="stable")
            for a in range(0, len(order), size):
                part = order[a:a + size]
                yield _pack(0, batch["id"].to_numpy()[part], x[part], pivots)
    return pack


def _distances(x, pivots):
    square = (x**2).sum(1)
    return np.sqrt(np.maximum(square[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1), 0))


def _search(q, q_ids, to_q, x, x_ids, to_x, k):
    """Row numbers (query, candidate, product) of the best k of this block for each query; to_q and to_x are rows of the pivot table."""
    order = np.argsort(x_ids, kind="stable")
    x, x_ids, to_x = x[order], x_ids[order], to_x[order]
    q_square, x_square = (q**2).sum(1), np.asarray((x**2).sum(1))
    out = []
    for i in range(len(q)):
        lower = np.abs(to_x - to_q[i]).max(1) - 1e-6
        upper = (q_square[i] + x_square - np.maximum(lower, 0) ** 2) / 2 + 1e-3
        upper[x_ids == q_ids[i]] = -np.inf
        turn = np.argsort(-upper, kind="stable")
        best = np.empty(0, np.int64)
        scores = np.empty(0)
        for a in range(0, len(turn), STEP):
            if len(scores) >= k and upper[turn[a]] < scores[-1]:
                break
            part = turn[a:a + STEP]
            part = part[upper[part] > -np.inf]
            best = np.concatenate([best, part])
            scores = np.concatenate([scores, x[part] @ q[i]])
            top = np.lexsort((best, -scores))[:k]
            best, scores = best[top], scores[top]
        out.append((np.full(len(best), q_ids[i]), x_ids[best], scores))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def top_k(queries, candidates, k=5, pivots=PIVOTS, sample=SAMPLE, query_block=QUERY_BLOCK, candidate_block=CANDIDATE_BLOCK):
    """(query_id, rank, id, score): the ``k`` candidates of largest product for each query; both inputs are (id, v)."""
    spark = candidates.sparkSession
    candidates, queries = land(candidates), land(queries)
    lengths = candidates.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = lengths[0]["dim"] if lengths else 0
    schema = "query_id long, id long, score long"
    if not dim:
        return spark.createDataFrame([], f"{schema}, rank int").select("query_id", "rank", "id", "score")
    candidates = candidates.filter(F.size("v") == dim)
    queries = queries.filter(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
    table = fit_pivots(candidates, pivots, sample)
    n_queries = queries.count()
    q_blocks = max(1, -(-n_queries // query_block))
    packed_q = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(q_blocks))).groupBy("block").applyInPandas(
        lambda key, g: _pack(key[0], g["id"], np.stack(g["v"].to_numpy()), table), _PACKED)
    packed_x = land(candidates.mapInPandas(_blocks_by_pivot(table, candidate_block), _PACKED))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(q_blocks - 1).cast("bigint")))
    wide = packed_x.select(every.alias("block"), F.col("ids").alias("x_ids"), F.col("vectors").alias("x_vectors"), F.col("distances").alias("x_distances"))
    pairs = wide.join(land(packed_q), "block").repartition(F.xxhash64("x_ids", "block"))

    def search(batches):
        for batch in batches:
            for row in batch.itertuples():
                def unpack(ids, vectors):
                    return np.frombuffer(ids, "<i8"), np.frombuffer(vectors, "<i8").reshape(-1, dim).astype(np.float64)
                (q_ids, q), (x_ids, x) = unpack(row.ids, row.vectors), unpack(row.x_ids, row.x_vectors)
                to_q, to_x = (np.frombuffer(d, "<f8").reshape(-1, len(table)) for d in (row.distances, row.x_distances))
                found = _search(q, q_ids, to_q, x, x_ids, to_x, k)
                yield pd.DataFrame({"query_id": found[0], "id": found[1], "score": found[2].astype(np.int64)})

    found = pairs.mapInPandas(search, schema)
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id")))
    return (
        found.groupBy("query_id").agg(F.slice(best, 1, k).alias("best"))
        .select("query_id", F.posexplode("best"))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.id", (-F.col("col.s")).alias("score"))
    )


def op10_top_k(spark, sf_dir):
    from .common import read_table

    vectors = usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    queries = vectors.filter(F.col("id") % 50 == 0)
    return top_k(queries, vectors).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP10_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
  from v q, v c where q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5
"""
