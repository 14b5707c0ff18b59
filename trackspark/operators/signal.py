"""Multi-resolution summaries of a signal track."""

from pyspark.sql import functions as F

STRETCH_BINS = 4096

def bin_signal(df, width, keys=("genome", "path", "chrom")):
    """Covered bases, sum, sum of squares, minimum and maximum per bin of ``width``.

    Values are weighted by the bases they cover in the bin. Each span yields one
    row per bin it touches, which are rows of the result.
    """
    keys = list(keys)
    lo, hi = F.col("bin") * width, (F.col("bin") + 1) * width
    bases = F.least("end", hi) - F.greatest("start", lo)
    # In two steps, so that a span of a whole contig makes no array of all its bins.
    stretch = width * STRETCH_BINS
    first = f"greatest(start div {width}, stretch * {STRETCH_BINS})"
    last = f"least((end - 1) div {width}, stretch * {STRETCH_BINS} + {STRETCH_BINS - 1})"
    span = [*keys, "start", "end", "value"]
    return (
        df.filter("start < end")  # a backwards sequence would yield a false bin
        .select(*span, F.explode(F.expr(f"sequence(start div {stretch}, (end - 1) div {stretch})")).alias("stretch"))
        .select(*span, F.explode(F.expr(f"sequence({first}, {last})")).alias("bin"))
        .select(*keys, "bin", "value", bases.alias("bases"))
        .groupBy(*keys, "bin")
        .agg(
            F.sum("bases").alias("covered"),
            F.sum(F.col("value") * F.col("bases")).alias("total"),
            F.sum(F.col("value") * F.col("value") * F.col("bases")).alias("total_sq"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )


def summarise_signal(df, reductions, keys=("genome", "path", "chrom")):
    """Summaries at each reduction (bin width); all must be multiples of the finest.

    Spans are cut into bins once, at the finest reduction. Its bins are then
    brought together by the coarsest bin they fall in, one shuffle that every
    coarser level shares.
    """
    keys = list(keys)
    levels = sorted(set(reductions))
    finest, coarsest = levels[0], levels[-1]
    if any(level % finest for level in levels):
        raise ValueError("each reduction must be a multiple of the finest")
    base = bin_signal(df, finest, keys)
    if len(levels) == 1:
        return base.withColumn("reduction", F.lit(finest))
    grouped = base.withColumn("_block", F.expr(f"bin div {-(-coarsest // finest)}")).repartition(*keys, "_block")
    frames = [grouped.drop("_block").withColumn("reduction", F.lit(finest))]
    for level in levels[1:]:
        by = [*keys, "_block"] if coarsest % level == 0 else keys
        frames.append(
            grouped.withColumn("bin", F.expr(f"bin div {level // finest}"))
            .groupBy(*by, "bin")
            .agg(
                F.sum("covered").alias("covered"),
                F.sum("total").alias("total"),
                F.sum("total_sq").alias("total_sq"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
            )
            .drop("_block")
            .withColumn("reduction", F.lit(level))
        )
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
