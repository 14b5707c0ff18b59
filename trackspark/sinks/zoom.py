"""Zoomed reads of written signal: a region in bins of any width, from the summaries that fit best.

``read_zoom`` takes whole bins from the coarsest summary that is no wider than the bins asked for, and cuts only the pieces at
their edges out of the records. So a view of a whole contig reads few summary rows, a close view reads records
of that region only, and both are exact: minima and maxima too, as no summary bin is split.
"""

import re

from pyspark.sql import functions as F

from ..sources.text import literal_path
from . import regions


def reductions_of(spark, path):
    """The bin widths that a signal table of ``write_signal`` is summarised at, from its folder names."""
    files = spark.read.parquet(literal_path(f"{path}/summaries")).inputFiles()
    return sorted({int(n) for file in files for n in re.findall(r"/reduction=(\d+)/", file)})


def _summed(rows, by):
    return rows.groupBy(*by).agg(
        F.sum("covered").alias("covered"), F.sum("total").alias("total"), F.sum("total_sq").alias("total_sq"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def read_zoom(spark, path, genome, chrom, start, end, width, keys=("genome", "path", "chrom"), reductions=None):
    """(keys, bin, bin_start, bin_end, covered, total, total_sq, low, high) of the bins of ``width`` from ``start`` to ``end`` with signal.

    The last bin ends at ``end``. ``path`` holds a table of ``write_signal`` whose records are indexed by ``write_index``.
    """
    if end <= start or width <= 0:
        raise ValueError("a zoomed read needs a region and a width of at least one position")
    keys = list(keys)
    fitting = [r for r in (reductions if reductions is not None else reductions_of(spark, path)) if r <= width]
    level = max(fitting, default=None)
    bins = spark.range(-(-(end - start) // width)).select(
        F.col("id").alias("bin"), (start + F.col("id") * width).alias("bin_start"),
        F.least(F.lit(end).cast("long"), start + (F.col("id") + 1) * width).alias("bin_end"))
    if level is None:
        edges, whole = bins.select("bin", F.col("bin_start").alias("start"), F.col("bin_end").alias("end")), None
    else:
        inner_start, inner_end = F.expr(f"(bin_start + {level - 1}) div {level} * {level}"), F.expr(f"bin_end div {level} * {level}")
        cut = bins.withColumn("_a", inner_start).withColumn("_b", inner_end)
        # A bin that holds no whole summary bin is one piece; others have a piece on either side.
        split = F.when(F.col("_a") >= F.col("_b"), F.array(F.struct("bin_start", "bin_end"))).otherwise(
            F.array(F.struct("bin_start", F.col("_a").alias("bin_end")), F.struct(F.col("_b").alias("bin_start"), "bin_end")))
        edges = cut.select("bin", F.explode(split).alias("e")).select("bin", F.col("e.bin_start").alias("start"), F.col("e.bin_end").alias("end"))
        edges = edges.filter("start < end")
        whole = _whole_bins(spark, path, genome, chrom, start, end, width, level, keys)
    wanted = edges.select(F.lit(genome).alias("genome"), F.lit(chrom).alias("chrom"), "start", "end", F.col("bin").alias("number"))
    records = regions.read_regions(spark, f"{path}/records", wanted).withColumn(
        "bases", F.least("end", "region_end") - F.greatest("start", "region_start")).filter("bases > 0")
    value = F.col("value")
    pieces = records.groupBy(*keys, F.col("region_number").alias("bin")).agg(
        F.sum("bases").alias("covered"), F.sum(value * F.col("bases")).alias("total"),
        F.sum(value * value * F.col("bases")).alias("total_sq"), F.min("value").alias("low"), F.max("value").alias("high"))
    rows = pieces if whole is None else _summed(pieces.unionByName(whole), [*keys, "bin"])
    return rows.select(
        *keys, "bin", (start + F.col("bin") * width).alias("bin_start"),
        F.least(F.lit(end).cast("long"), start + (F.col("bin") + 1) * width).alias("bin_end"), "covered", "total", "total_sq", "low", "high")


def _whole_bins(spark, path, genome, chrom, start, end, width, level, keys):
    """Summary bins of one level that lie inside one bin of the view, by that bin."""
    at = F.col("bin") * level
    table = spark.read.option("basePath", f"{path}/summaries").parquet(literal_path(f"{path}/summaries/genome={genome}/reduction={level}"))
    inside = table.withColumn("genome", F.lit(genome)).filter(
        (F.col("chrom") == chrom) & (F.col("bin") >= -(-start // level)) & (F.col("bin") < end // level))
    # Within one bin of the view: begins and ends in it, as floor((position - start) / width) tells.
    first, last = F.floor((at - start) / width), F.floor((at + level - 1 - start) / width)
    return inside.filter(first == last).select(*keys, first.cast("long").alias("bin"), "covered", "total", "total_sq", "low", "high")
