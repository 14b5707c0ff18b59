"""Sinks: tables clustered by genome, contig and start, and the catalog."""

from pyspark.sql import functions as F

from ..functions.values import joined_list
from ..operators.catalog import check_unique_names
from ..operators.contigs import EmptySizesError
from ..operators.intervals import find_overlaps, order_columns
from ..operators.ranges import RANGE_BYTES, clustered_by_bytes
from ..operators.scratch import folders_unsorted
from ..operators.signal import summarise_signal
from ..schemas import BIG_GENE_PRED


class OverlapError(ValueError):
    """Raised when records of a signal track overlap."""


def ranges_for(spark, paths, bytes_per_range=256 << 20):
    """Number of output ranges for input files of this total size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    return max(1, -(-total // bytes_per_range))


def clustered(df, partitions=None, per_range=RANGE_BYTES):
    """Rows in ranges of (genome, chrom, start, whole record), sorted within each.

    Readers prune regions by the minimum and maximum of each row group. Ranges hold about ``per_range`` bytes, measured, unless
    ``partitions`` gives their number. The input partition is the last key, so that equal records can be in several ranges.
    """
    if not partitions:
        return clustered_by_bytes(df, per_range)
    keys = order_columns(df)
    ranged = df.withColumn("_from", F.spark_partition_id()).repartitionByRange(partitions, *keys, "_from")
    return ranged.sortWithinPartitions(*keys).drop("_from")


def _write(df, path, by, mode):
    with folders_unsorted(df.sparkSession):
        df.write.mode(mode).partitionBy(*by).parquet(path)


def write_intervals(df, path, partitions=None, mode="errorifexists", per_range=RANGE_BYTES):
    """Interval records as Parquet, one folder per genome. ``df`` is read twice: land it first where it is costly."""
    _write(clustered(df, partitions, per_range), path, ["genome"], mode)


def write_signal(
    df, path, reductions, keys=("genome", "path", "chrom"), partitions=None, mode="errorifexists", on_overlap="report"
):
    """Signal under ``records``, its summaries under ``summaries``, and ``overlaps``.

    Overlaps and summaries are made from the records as written, which are sorted
    and columnar, not from their source. ``on_overlap='error'`` raises after the
    overlapping records are written.
    """
    write_intervals(df, f"{path}/records", partitions, mode)
    spark = df.sparkSession
    written = spark.read.schema(df.schema).parquet(f"{path}/records")
    find_overlaps(written, keys).write.mode(mode).parquet(f"{path}/overlaps")
    if on_overlap == "error" and spark.read.parquet(f"{path}/overlaps").limit(1).count():
        raise OverlapError(f"signal records overlap; they are listed in {path}/overlaps")
    summaries = summarise_signal(written, reductions, keys)
    ordered = [*keys, "bin"]
    # A bin is a row of fixed size, so ranges of equal rows are ranges of equal bytes.
    ranges = [partitions] if partitions else []
    placed = summaries.repartitionByRange(*ranges, "reduction", *ordered).sortWithinPartitions("reduction", *ordered)
    _write(placed, f"{path}/summaries", ["genome", "reduction"], mode)


def write_gene_models(rows, path, partitions=None, mode="errorifexists"):
    """bigGenePred rows as Parquet, one folder per genome."""
    named = rows.withColumnRenamed("chromStart", "start").withColumnRenamed("chromEnd", "end")
    placed = clustered(named, partitions)
    placed = placed.withColumnRenamed("start", "chromStart").withColumnRenamed("end", "chromEnd")
    _write(placed, path, ["genome"], mode)


def biggenepred_lines(rows):
    """bigGenePred rows as tab-separated text in a ``value`` column."""
    columns = []
    for name, kind in BIG_GENE_PRED:
        text = joined_list(name) if kind.startswith("array") else F.col(name).cast("string")
        columns.append(F.coalesce(text, F.lit("")))
    return rows.select(F.concat_ws("\t", *columns).alias("value"))


def write_chrom_sizes(sizes, path, mode="errorifexists"):
    """``name TAB size`` text, one folder per genome; no rows at all is an error."""
    if not sizes.limit(1).count():
        raise EmptySizesError("no chromosome sizes to write; check the assembly report")
    rows = sizes.select("genome", "name", F.col("size").cast("string"))
    rows.write.mode(mode).partitionBy("genome").option("sep", "\t").csv(path)


def publish(catalog, path, mode="errorifexists", unique_names=True):
    """Catalog rows, one folder per hub and genome; two tracks of one name in a hub raise.

    Rebalancing splits a hub that holds many rows and merges the small ones.
    """
    if unique_names and "params" in catalog.columns:
        check_unique_names(catalog)
    spread = catalog.hint("rebalance", "hub", "genome")
    spread.write.mode(mode).partitionBy("hub", "genome").parquet(path)
