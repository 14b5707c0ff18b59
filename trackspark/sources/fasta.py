"""Sequence lengths from FASTA text."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..operators.scratch import land
from .text import read_ordered_lines

CHUNK_LINES = 8192


def sequence_lengths(lines, keys=("path",), chunk_lines=CHUNK_LINES):
    """(keys, name, size, block, line) for each record of ``lines`` (keys, block, line, value).

    The length of a record is the number of bases before the next header less the
    number before its own. Chunks of lines are summed before the shuffle, so that
    only chunks that hold a header travel line by line.

    The text is read once: its line lengths are landed, which also pins the line
    numbers, since a second scan could be split in another way.
    """
    keys = list(keys)
    chunk = [*keys, "block", "chunk"]
    is_header = F.col("value").startswith(">")
    marked = land(lines.select(
        *keys,
        "block",
        "line",
        F.when(is_header, F.regexp_extract("value", r"^>(\S*)", 1)).alias("name"),
        F.when(is_header, 0).otherwise(F.length(F.translate("value", " \t\r\n", ""))).cast("bigint").alias("bases"),
    )).withColumn("chunk", F.expr(f"line div {chunk_lines}"))
    along = Window.partitionBy(*keys).orderBy("block", "chunk")
    totals = (
        marked.groupBy(*chunk)
        .agg(F.sum("bases").alias("total"), F.count("name").alias("headers"))
        .select(
            *chunk,
            "headers",
            F.coalesce(
                F.sum("total").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("carry"),
            F.sum("total").over(Window.partitionBy(*keys)).alias("file_total"),
        )
        .filter("headers > 0")
        .drop("headers")
    )
    within = Window.partitionBy(*chunk).orderBy("line")
    local = F.coalesce(F.sum("bases").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = (
        lookup_join(marked, totals, chunk, "inner")
        .withColumn("start", F.col("carry") + local)
        .filter("name is not null")
        .withColumn("next_start", F.lead("start").over(within))
    )
    # The last header of a chunk runs to the first header of the next one that has any.
    following = heads.groupBy(*chunk).agg(F.min("start").alias("first")).select(
        *chunk, F.lead("first").over(along).alias("next_first")
    )
    size = F.coalesce("next_start", "next_first", "file_total") - F.col("start")
    return heads.join(following, chunk).select(*keys, "name", size.alias("size"), "block", "line")


def fasta_chrom_sizes(spark, paths, genome=None):
    """(genome, name, size) of the sequences in FASTA files."""
    sizes = sequence_lengths(read_ordered_lines(spark, paths))
    return sizes.select(F.lit(genome).cast("string").alias("genome"), "name", "size")
