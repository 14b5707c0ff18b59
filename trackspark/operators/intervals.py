"""Interval records: bounds, overlaps, order and depth of coverage."""

from pyspark.sql import functions as F

from .lookup import lookup_join
from .scratch import land
from .signal import summarise_signal
from .tiles import TILE_WIDTH, running_before


def check_bounds(harmonised, allow_empty=True):
    """Tag harmonised records with ``reject_reason`` (null for a good record).

    ``allow_empty`` admits zero-length records, as BED does and bedGraph does not. A contig whose size could not be read
    cannot bound its records, so they are rejected; so are signal records, which
    must not be empty, of a missing or NaN ``value``.
    """
    start, end, size = F.col("start"), F.col("end"), F.col("contig_size")
    backwards = end < start if allow_empty else end <= start
    reason = (
        F.when(start.isNull() | end.isNull(), "unreadable_position")
        .when(start < 0, "negative_start")
        .when(backwards, "end_before_start")
        .when(size.isNull(), "unknown_contig_size")
        .when(end > size, "end_past_contig")
    )
    if not allow_empty and "value" in harmonised.columns:
        reason = reason.when(F.col("value").isNull() | F.isnan("value"), "unreadable_value")
    return harmonised.withColumn("reject_reason", reason)


def validate_bounds(harmonised, allow_empty=True):
    """Split harmonised records into those within their contig and the rest."""
    tagged = check_bounds(harmonised, allow_empty)
    return (
        tagged.filter("reject_reason is null").drop("reject_reason"),
        tagged.filter("reject_reason is not null"),
    )


def order_columns(df, first=("genome", "chrom", "start", "end")):
    """Sort columns: contig by bytes, start as a number, then the rest of the record."""
    leading = [c for c in first if c in df.columns]
    orderable = [
        f.name
        for f in df.schema.fields
        if f.name not in leading and not f.dataType.simpleString().startswith("map")
    ]
    return leading + orderable


def sort_intervals(df):
    """Total order on (genome, chrom, start, whole record).

    The input partition comes last, so that copies of one record can be spread
    over several output ranges.
    """
    return (
        df.withColumn("_from", F.spark_partition_id())
        .orderBy(*order_columns(df), "_from")
        .drop("_from")
    )


def find_overlaps(df, keys=("genome", "path", "chrom"), width=TILE_WIDTH):
    """Records that start before an earlier record of the same track and contig ends.

    Records are ordered by start, end and then their other columns. Equal records
    come out once, with ``copies`` telling how many of them overlap.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in ("start", "end")]
    at = [*keys, "start"]
    starts = df.groupBy(*at).agg(F.max("end").alias("reach"), F.count("*").alias("_at_start"))
    ends = df.select(*at, F.col("end").alias("reach"))
    reached = F.coalesce(F.col("before") > F.col("start"), F.lit(False))
    # Few starts can overlap in a well-formed track, so only their records go on.
    suspects = land(
        running_before(starts, keys, "start", "reach", "max", width, carry_from=ends)
        .filter(reached | (F.col("_at_start") > 1))
        .select(*at, reached.alias("_reached"))
    )
    counted = (
        lookup_join(df, suspects, at, "inner")
        .groupBy(*at, "end", *rest, "_reached")
        .agg(F.count("*").alias("_copies"))
    )
    # Where nothing earlier reaches the start, its first non-empty record is clear. Copies are merged before records are compared.
    record = F.struct("end", *rest)
    may_lead = ~F.col("_reached") & (F.col("end") > F.col("start")) & (F.col("_copies") > 0)
    leads = counted.filter(may_lead).groupBy(*at).agg(F.min(record).alias("_lead"))
    overlapping = (
        F.when(F.col("_reached"), F.col("_copies"))
        .when(F.col("end") <= F.col("start"), F.lit(0))
        .otherwise(F.col("_copies") - record.eqNullSafe(F.col("_lead")).cast("bigint"))
    )
    return (
        counted.join(leads, at, "left")
        .select(*df.columns, overlapping.cast("bigint").alias("copies"))
        .filter("copies > 0")
    )


def coverage_depth(df, keys=("genome", "path", "chrom"), width=TILE_WIDTH):
    """Maximal runs of equal, non-zero depth: (keys, start, end, depth)."""
    keys = list(keys)
    edges = F.array(
        F.struct(F.col("start").alias("pos"), F.lit(1).alias("step")),
        F.struct(F.col("end").alias("pos"), F.lit(-1).alias("step")),
    )
    steps = (
        df.filter("start < end")
        .select(*keys, F.inline(edges))
        .groupBy(*keys, "pos")
        .agg(F.sum("step").alias("step"))
        .filter("step != 0")
    )
    return (
        running_before(steps, keys, "pos", "step", "sum", width)
        .select(
            *keys,
            F.col("pos").alias("start"),
            F.col("next_pos").alias("end"),
            (F.col("before") + F.col("step")).alias("depth"),
        )
        .filter("depth > 0")
    )


def summarise_coverage(df, reductions, keys=("genome", "path", "chrom"), width=TILE_WIDTH):
    """Depth of coverage summarised per bin, at each reduction."""
    depth = coverage_depth(df, keys, width).withColumnRenamed("depth", "value")
    return summarise_signal(depth, reductions, keys)
