"""Centroid clustering by Lloyd's rounds, sharded by dimension, on integers.

A vector is cut into column blocks of ``WIDTH`` dimensions, and ``CHUNK`` vectors of one block are one row of a table
bucketed by (block, chunk). A centroid is cut alike: a block's tasks hold only that block's slice of the centroids. In each round a
task computes, for its chunks, the exact squared distances to every centroid over its own dimensions; these partial distances are
added by chunk and their least gives the clusters. The clusters, one small number per vector, go back to the blocks, where the
vectors stayed; each block adds up its own dimensions by cluster and moves its own slice. So vectors are shuffled once, at
the start, and a round moves partial distances and clusters only. The slices have clusters times dimensions numbers,
whatever the number of vectors.

The bucketed table lies in the scratch folder under a name of its own and is dropped from the catalog at the end.

Defined cases: vectors that are null, not of exactly ``dims`` components, or hold a null or non-finite component take no part. The
others become floor(scale * x), x as double; a component whose integer has 2^27 or more raises, as its squares could not
be summed in 64 bits. Every row is a vector, rows of equal or null vec_id too; a null id is hashed as ''. Of equal
hashes the lesser vector starts first. With fewer vectors than clusters, each is a centroid. An empty table gives no
rows. Columns beyond vec_id and embedding are never read.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.scratch import scratch_dir
from .common import land, read_table

DIMS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
WIDTH = 16
CHUNK = 2048
SEED = 3
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole_vectors(embeddings, dims=DIMS, scale=SCALE):
    """(vec_id, x): the vectors that take part, as integers."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    scaled = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("long"))
    fits = F.forall("x", lambda v: F.abs(v) < 1 << 27)
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .filter((F.size("embedding") == dims) & finite)
        .select("vec_id", scaled.alias("x"))
        .withColumn("x", F.when(fits, F.col("x")).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))))
    )


def first_centroids(vectors, clusters, width, seed=SEED):
    """(block, cluster, dim, value): the vectors whose hashed ids come first."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = vectors.withColumn("_hash", order).orderBy("_hash", "x").limit(clusters)
    numbered = chosen.withColumn("cluster", F.row_number().over(Window.orderBy("_hash", "x")) - 1)
    exploded = numbered.select("cluster", F.posexplode("x").alias("dim", "value"))
    return land(exploded.select(F.expr(f"dim div {width}").cast("int").alias("block"), "cluster", "dim", "value"))


def _pack(width, chunk):
    """Rows (chunk, block, ids, values) from vectors: one per block of dimensions, and one of block -1 for the ids."""
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                n = part.num_rows
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(n, -1)
                cuts = [x[:, a:a + width] for a in range(0, x.shape[1], width)]
                ids = part.column("vec_id").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * (len(cuts) + 1), pa.int64()), pa.array([-1, *range(len(cuts))], pa.int32()),
                    pa.array([ids] + [None] * len(cuts), pa.list_(pa.int64())),
                    pa.array([None] + [np.ascontiguousarray(c).tobytes() for c in cuts], pa.binary())], ["chunk", "block", "ids", "values"])
                number += 1
    return run


def _matrix(values, columns):
    return np.frombuffer(values, np.int32).reshape(-1, columns).astype(np.int64)


def _partial_distances(clusters):
    """Squared distances of each chunk to every centroid, over the dimensions of one block."""
    def run(batches):
        for batch in batches:
            found = []
            for values, own in zip(batch.column("values").to_pylist(), batch.column("slice").to_pylist(), strict=True):
                centres = np.array(own, np.int64).reshape(clusters, -1)
                x = _matrix(values, centres.shape[1])
                found.append(np.stack([((x - c) ** 2).sum(1) for c in centres], 1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(found, pa.binary())], ["chunk", "parts"])
    return run


def _nearest(clusters):
    """Add the blocks of one chunk; the nearest centroid of each vector, of equal ones the first."""
    def run(table):
        total = 0
        for parts in table.column("parts").to_pylist():
            total = total + np.frombuffer(parts, np.int64).reshape(-1, clusters)
        label = total.argmin(1)
        return pa.table({
            "chunk": table.column("chunk").slice(0, 1),
            "labels": pa.array([label.astype(np.int32)], pa.list_(pa.int32())),
            "distances": pa.array([total[np.arange(len(label)), label]], pa.list_(pa.int64()))})
    return run


def _sums(clusters, width):
    """(block, cluster, dim, total, n) over the chunks of one task."""
    def run(batches):
        held = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "values", "labels"))
            for block, values, labels in zip(*columns, strict=True):
                x, labels = _matrix(values, len(values) // 4 // len(labels)), np.array(labels)
                total, n = held.setdefault(block, (np.zeros((clusters, x.shape[1]), np.int64), np.zeros(clusters, np.int64)))
                np.add.at(total, labels, x)
                n += np.bincount(labels, minlength=clusters)
        for block, (total, n) in held.items():
            cluster, dim = (i.ravel() for i in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(total.size, block), pa.int32()), pa.array(cluster, pa.int32()), pa.array(dim + block * width, pa.int32()),
                 pa.array(total.ravel(), pa.int64()), pa.array(n[cluster], pa.int64())], ["block", "cluster", "dim", "total", "n"])
    return run


def _slices(centroids):
    """(block, slice), one row per block: its part of all centroids."""
    ordered = F.array_sort(F.collect_list(F.struct("cluster", "dim", "value")))
    return centroids.groupBy("block").agg(F.transform(ordered, lambda c: c["value"]).alias("slice"))


def assign(blocks, centroids, clusters):
    """(chunk, labels, distances) of every chunk to its nearest centroids."""
    placed = blocks.filter("block >= 0").join(F.broadcast(_slices(centroids)), "block")
    parts = placed.select("chunk", "values", "slice").mapInArrow(_partial_distances(clusters), "chunk long, parts binary")
    return land(parts.groupBy("chunk").applyInArrow(_nearest(clusters), "chunk long, labels array<int>, distances array<long>"))


def move(blocks, labels, centroids, clusters, dims, width):
    """The centroids after one round: each block takes the floor of the mean of its own dimensions."""
    sent = labels.select("chunk", "labels", F.explode(F.sequence(F.lit(0), F.lit(-(-dims // width) - 1))).alias("block"))
    held = blocks.filter("block >= 0").select("block", "chunk", "values").join(sent.hint("merge"), ["block", "chunk"])
    sums = held.select("block", "values", "labels").mapInArrow(
        _sums(clusters, width), "block int, cluster int, dim int, total long, n long")
    mean = sums.groupBy("block", "cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).filter("n > 0").select(
        "block", "cluster", "dim", F.expr("(total - pmod(total, n)) div n").alias("mean"))
    moved = centroids.join(F.broadcast(mean), ["block", "cluster", "dim"], "left")
    return land(moved.select("block", "cluster", "dim", F.coalesce("mean", "value").alias("value")))


def cluster_vectors(embeddings, clusters=CLUSTERS, rounds=ROUNDS, dims=DIMS, scale=SCALE, width=WIDTH, chunk=CHUNK, seed=SEED):
    """(assigned, centroids): (vec_id, cluster, distance) of every vector and (block, cluster, dim, value) at the end."""
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings, dims, scale)
    centroids = first_centroids(vectors, clusters, width, seed)
    clusters = min(clusters, centroids.select("cluster").distinct().count())
    if not clusters:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    name = f"trackspark_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = vectors.mapInArrow(_pack(width, chunk), "chunk long, block int, ids array<long>, values binary")
    (packed.repartition(buckets, "block", "chunk").write.bucketBy(buckets, "block", "chunk").sortBy("block", "chunk")
     .option("path", f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{name}").saveAsTable(name))
    try:
        blocks = spark.table(name)
        for _ in range(rounds):
            centroids = move(blocks, assign(blocks, centroids, clusters), centroids, clusters, dims, width)
        labels = assign(blocks, centroids, clusters)
        ids = blocks.filter("block = -1").select("chunk", "ids").join(labels, "chunk")
        rows = ids.select(F.inline(F.arrays_zip("ids", "labels", "distances")))
        return land(rows.select(F.col("ids").alias("vec_id"), F.col("labels").alias("cluster"), F.col("distances").alias("distance"))), centroids
    finally:
        spark.sql(f"drop table if exists {name}")


def with_inertia(assigned, centroids):
    """``assigned`` with the inertia of each cluster and of all, and the hash of the final centroid."""
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).withColumn(
        "inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(1))))
    values = F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda c: c["value"].cast("string"))
    digests = centroids.groupBy("cluster").agg(F.sha2(F.array_join(values, ",").cast("binary"), 256).alias("centroid_sha256"))
    return assigned.join(F.broadcast(inertia.join(digests, "cluster")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark, sf_dir):
    return with_inertia(*cluster_vectors(read_table(spark, sf_dir, "embeddings")))


def _sql(rounds=ROUNDS):
    """The rounds written out one after another."""
    step = """
d{r} as materialized (
  select r, cluster, distance from (
    select x.r, c.cluster, sum((x.v - c.v) * (x.v - c.v))::bigint as distance from x join c{r} c on x.dim = c.dim group by all)
  qualify row_number() over (partition by r order by distance, cluster) = 1),"""
    move_ = """
m{r} as materialized (
  select d.cluster, x.dim, sum(x.v)::bigint as s, count(*) as n from x join d{r} d on x.r = d.r group by all),
c{t} as materialized (
  select c.cluster, c.dim, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.v)::bigint as v
  from c{r} c left join m{r} m on m.cluster = c.cluster and m.dim = c.dim),"""
    return """
with e as materialized (
  select row_number() over () as r, vec_id, [floor(1024 * v::double)::bigint for v in embedding] as x from embeddings
  where len(embedding) = 64 and len([v for v in embedding if v is null or not isfinite(v)]) = 0),
x as materialized (select r, unnest(x) as v, generate_subscripts(x, 1) as dim from e),
f as (select r, row_number() over (order by sha256('3:' || coalesce(vec_id::varchar, '')), x) - 1 as cluster from e
      qualify cluster < 8),
c0 as materialized (select f.cluster, x.dim, x.v from f join x on x.r = f.r),""" + "".join(
        step.format(r=r) + move_.format(r=r, t=r + 1) for r in range(rounds)) + step.format(r=rounds) + f"""
i as (select cluster, sum(distance)::bigint as cluster_inertia from d{rounds} group by cluster),
h as (select cluster, sha256(string_agg(v::varchar, ',' order by dim)) as centroid_sha256 from c{rounds} group by cluster)
select e.vec_id, d.cluster::int as cluster, d.distance, i.cluster_inertia, (select sum(distance) from d{rounds})::bigint as inertia, h.centroid_sha256
from d{rounds} d join e on e.r = d.r join i on i.cluster = d.cluster join h on h.cluster = d.cluster
"""


OP12_SQL = _sql()
