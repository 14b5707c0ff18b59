"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Each source gets a target in words. Its documents, in order of size and id, all expect
``target / source size`` copies; the running sum of what they expect, shifted by one offset per
source, crosses an integer once for every copy to emit. Neighbours in the order have
almost the same size, so the words taken differ from the target by little more than one document.

Running sums need no task per source: documents are dealt out in ranges of (source, size, id), each
range counts its documents, and only these counts are summed along a source.

Defined cases: a null text has size 0; null sources form one source, the last in order; null ids are
one id. Rows of equal id, source and size are one document that is drawn once, and each of them gets
its copies. A source without words has target 0 and gives no copies. An empty table gives no rows.
Columns beyond doc_id, text and source are kept by
``mix_documents`` and never read; a column ``copy`` is replaced.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import keyed_join, land, others, word_count

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # the mix has 150% of all words, as a fraction of integers
LIMIT = 2  # a source, and a document, is taken this many times at most


def source_targets(sized, weights=WEIGHTS, share=SHARE, limit=LIMIT):
    """(source, source_size, target): words to take from each source.

    Sources by code point, null last, take the weights in turn. A source stops at ``limit`` times its
    size; the rest is shared anew by weight. This is filling to one level: sources in order of the
    level at which they stop, and the first that does not stop fixes the level. One row per source.
    """
    number, of = share
    turn = F.array(*(F.lit(w).cast("long") for w in weights))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(turn, ((F.row_number().over(names) - 1) % len(weights) + 1).cast("int")))
    )
    stops = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    after = stops.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = sources.select(
        "*",
        (F.sum("source_size").over(everything) * number
         - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * limit * of).alias("left"),
        (F.sum("weight").over(after) * of).alias("parts"),
    )
    # Not stopped: limit * source_size >= weight * left / parts. Integers, so no rounding decides.
    free = F.col("source_size") * limit * F.col("parts") >= F.col("weight") * F.col("left")
    first = F.min(F.when(free, F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source",
                                        "left", "parts"))).over(everything)
    return level.withColumn("level", first).select(
        "source",
        "source_size",
        F.least(
            (F.col("source_size") * limit).cast("double"),
            (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.parts"),
        ).alias("target"),
    )


def offset(source, seed):
    """One offset in [0, 1) per source, the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def draw(documents, weights=WEIGHTS, share=SHARE, limit=LIMIT, seed=7, ranges=None):
    """(doc_id, source, size, source_size, target, copies), one row per row of ``documents``."""
    spark = documents.sparkSession
    sized = land(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = land(source_targets(sized, weights, share, limit))
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = land(
        sized.distinct()
        .repartitionByRange(ranges, F.col("source").asc_nulls_last(), "size", "doc_id")
        .withColumn("part", F.spark_partition_id())
    )
    along = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("source", "part").agg(F.count("*").alias("n")).select(
        "source", "part", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("start")
    )
    ordered = Window.partitionBy("source", "part").orderBy("size", "doc_id")
    placed = dealt.withColumn("place", F.row_number().over(ordered))
    placed = keyed_join(placed, starts, ["source", "part"])
    placed = keyed_join(placed, targets, ["source"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("start") + F.col("place")
    u = offset(F.col("source"), seed)
    copies = (F.floor(expected * place + u) - F.floor(expected * (place - 1) + u)).cast("long")
    drawn = placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))
    return keyed_join(sized, drawn, ["doc_id", "source", "size"])


def mix_documents(documents, **options):
    """The rows of ``documents`` as often as they are drawn, with a copy number from 1."""
    kept = documents.select(*others(documents, "copy")).withColumn("_size", word_count(F.col("text")))
    drawn = (
        draw(documents, **options)
        .select("doc_id", "source", F.col("size").alias("_size"), F.col("copies").alias("_copies"))
        .distinct()
        .filter("_copies > 0")
    )
    return (
        keyed_join(kept, drawn, ["doc_id", "source", "_size"], "inner", measured=False)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        .drop("_size", "_copies")
    )


def op7_mix_sources(spark, sf_dir):
    from .common import read_table

    return draw(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


OP7_SQL = r"""
with sized as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as weight
  from sized group by source),
levels as (
  select *, (sum(source_size) over () * 3
             - coalesce(sum(source_size) over (w rows between unbounded preceding and 1 preceding), 0) * 4)::bigint as rest,
         (sum(weight) over (w rows between current row and unbounded following) * 2)::bigint as parts
  from sources window w as (order by source_size / weight, source nulls last)),
free as (
  select rest, parts from levels where source_size * 2 * parts >= weight * rest
  order by source_size / weight, source nulls last limit 1),
targets as (
  select source, source_size,
         least((source_size * 2)::double, (weight * free.rest)::double / free.parts) as target
  from levels, free),
placed as (
  select *, row_number() over (partition by source order by size, doc_id nulls first) as place
  from (select distinct * from sized)),
drawn as (
  select p.doc_id, p.source, p.size, t.source_size, t.target, p.place,
         case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as expected,
         ('0x' || substr(md5('7:' || coalesce(p.source, '')), 1, 8))::bigint::double / 4294967296.0::double as u
  from placed p join targets t on p.source is not distinct from t.source)
select s.doc_id, s.size, d.source_size, d.target,
       (floor(expected * place + u) - floor(expected * (place - 1) + u))::bigint * s.size as taken,
       (floor(expected * place + u) - floor(expected * (place - 1) + u))::bigint as copies
from sized s join drawn d on s.doc_id is not distinct from d.doc_id
  and s.source is not distinct from d.source and s.size = d.size
"""
