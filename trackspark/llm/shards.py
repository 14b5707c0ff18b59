"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

A uniform permutation of all rows sends a random number of rows from each input partition to each shard. These numbers are a
matrix with fixed sums: a row per partition, a column per shard, and follow the multivariate hypergeometric law. They are
drawn by halving: the rows of all partitions of a range are split between its two halves, shard by shard, then each
half likewise. Every draw is seeded by its range, so any task draws its own partition's row of the matrix, and how many rows of each
shard went to the partitions before it, in a few steps, from the row counts alone. No matrix is gathered.

Within a partition a random permutation decides which rows make up those numbers; within a shard another one decides the slots of
the rows that arrive. Both are permutations of 0 to n - 1 computed row by row, by swap-or-not rounds, so no
group is sorted or held together, however large a partition or a shard is. Then one exchange brings the rows to partitions of
consecutive slots.

The rows are written once before, so that their places stay the same when tasks run again. Law: ``rows``, counts of
the shards at most one apart, the first shards taking the odd rows. Reruns over the same partitions agree.

Defined cases: any column may be null; rows of equal values are rows of their own, each with a slot. Long texts move as they
are and never pass through Python. With fewer rows than shards, the last shards are empty. An empty table gives no
rows. Input columns named ``shard`` or ``slot`` are replaced; all others are kept and not read. At most ``PARTITIONS`` input
partitions are told apart, beyond that they are merged, so that the counts sent to tasks stay under 1 MB.
"""

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .common import land, others, read_table

SHARDS = 16
SEED = 11
PARTITIONS = 1 << 16
MIX_ROUNDS = 96
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition


def hypergeometric(good, total, drawn, rng):
    """How many of ``drawn`` out of ``total`` are among the ``good`` ones, by inversion around the mode."""
    low, high = max(0, drawn - (total - good)), min(drawn, good)
    if low == high:
        return low
    mode = (drawn + 1) * (good + 1) // (total + 2)
    deviation = (drawn * (good / total) * (1 - good / total) * ((total - drawn) / max(total - 1, 1))) ** 0.5
    reach = int(12 * deviation) + 60
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    # ratio of the chance of k + 1 to that of k
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (total - good - drawn + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chances = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(chances, rng.random() * chances[-1], side="right"))


def split_counts(sizes, drawn, rng):
    """How many of ``drawn`` rows, taken from groups of ``sizes`` without return, come from each group."""
    left, taken = int(sum(sizes)), []
    for size in sizes:
        got = hypergeometric(int(size), left, drawn, rng) if drawn else 0
        taken.append(got)
        left, drawn = left - int(size), drawn - got
    return tuple(taken)


def shard_sizes(rows, shards):
    return tuple(rows // shards + (s < rows % shards) for s in range(shards))


class Matrix:
    """Rows of the communication matrix for partitions of the given row counts."""

    def __init__(self, counts, shards, seed):
        self.before = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))])
        self.shards, self.seed = shards, seed
        self.sizes = shard_sizes(int(self.before[-1]), shards)
        self._left = lru_cache(maxsize=4096)(self._left)

    def _left(self, first, last, sizes):
        """What the first half of partitions first to last - 1 sends to each shard."""
        middle = (first + last) // 2
        rng = np.random.Generator(np.random.PCG64([self.seed, first, last]))
        return split_counts(sizes, int(self.before[middle] - self.before[first]), rng)

    def row(self, partition):
        """(counts, offsets): the rows of ``partition`` for each shard, and those of earlier partitions."""
        first, last, sizes, offsets = 0, len(self.before) - 1, self.sizes, (0,) * self.shards
        while last - first > 1:
            middle, left = (first + last) // 2, self._left(first, last, sizes)
            if partition < middle:
                last, sizes = middle, left
            else:
                offsets = tuple(o + x for o, x in zip(offsets, left, strict=True))
                first, sizes = middle, tuple(s - x for s, x in zip(sizes, left, strict=True))
        return sizes, offsets


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(places, n, key):
    """The images of ``places`` under a random permutation of 0 to n - 1 that ``key`` fixes, by swap-or-not rounds."""
    x = np.asarray(places, np.int64)
    rng = np.random.Generator(np.random.PCG64(key))
    for turn, salt in zip(rng.integers(0, n, MIX_ROUNDS), rng.integers(0, 2**63, MIX_ROUNDS, dtype=np.uint64), strict=True):
        partner = np.where(x <= turn, turn - x, turn - x + n)
        swap = _mixed(np.maximum(x, partner).astype(np.uint64) ^ salt) & np.uint64(1)
        x = np.where(swap == 1, partner, x)
    return x


@lru_cache(maxsize=4)
def _matrix(counts, shards, seed):
    return Matrix(counts, shards, seed)


def _placed(counts, shards, seed):
    """A function of row numbers that gives their shards and slots."""
    @F.pandas_udf("shard int, slot long")
    def place(rows: pd.Series) -> pd.DataFrame:
        rows, matrix = rows.to_numpy(), _matrix(counts, shards, seed)
        partition, number = rows >> _ROW_BITS, rows & ((1 << _ROW_BITS) - 1)
        shard, slot = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int64)
        for p in np.unique(partition):
            mine = np.flatnonzero(partition == p)
            sends, offsets = matrix.row(int(p))
            ends = np.cumsum(sends)
            turn = permuted(number[mine], int(ends[-1]), [seed, 1, int(p)])
            to = np.searchsorted(ends, turn, side="right")
            shard[mine] = to
            slot[mine] = turn - (ends - np.array(sends))[to] + np.array(offsets)[to]
        for s in np.unique(shard):
            mine = np.flatnonzero(shard == s)
            slot[mine] = permuted(slot[mine], matrix.sizes[s], [seed, 2, int(s)])
        return pd.DataFrame({"shard": shard, "slot": slot})

    return place


def shuffle_to_shards(df, shards=SHARDS, seed=SEED):
    """The rows of ``df`` with ``shard`` and ``slot``, in partitions of consecutive slots of one shard after another."""
    spark = df.sparkSession
    rest = others(df, "shard", "slot")
    packed = F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row")
    rows = land(df.select(packed).coalesce(PARTITIONS).select(F.monotonically_increasing_id().alias("_id"), "_row"))
    found = rows.groupBy(F.shiftright("_id", _ROW_BITS).alias("p")).agg(F.count("*").alias("n")).collect()
    counts = [0] * (1 + max((r.p for r in found), default=-1))
    for r in found:
        counts[r.p] = r.n
    total = sum(counts)
    if not total:
        return df.select(*(F.col(f"`{c}`") for c in rest), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    place = _placed(tuple(counts), shards, seed)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Shards are of nearly equal size, so equal parts of (shard, slot / size) hold equal numbers of rows.
    largest = shard_sizes(total, shards)[0]
    part = F.expr(f"cast((at.shard * {largest} + at.slot) * {parts} div {largest * shards} as int)")
    placed = rows.select("_row", place("_id").alias("at")).repartitionById(parts, part)
    sorted_ = placed.select("_row", "at.shard", "at.slot").sortWithinPartitions("shard", "slot")
    return sorted_.select(*(F.col(f"_row.`{c}`").alias(c) for c in rest), "shard", "slot")


def op11_shard_shuffle(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return shuffle_to_shards(read_table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
