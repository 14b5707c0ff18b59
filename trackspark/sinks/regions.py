"""Region reads of clustered interval tables, by an index of their blocks.

``write_index`` keeps, beside a table of ``write_intervals``, one small row for every ``BLOCK_ROWS`` rows of every file and contig:
the least start, the greatest end, and ``reach``, the greatest end of that block and all before it on the contig. A record that
begins far before a region but reaches into it lies in a block whose greatest end says so, so the files to open are known
without opening any other, however long the longest span is. Inside a file Parquet's own row-group bounds of
start and end do the rest.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..sources.text import literal_path

BLOCK_ROWS = 1 << 16
TILE = 1 << 17  # positions; regions and records of one tile meet


def index_path(path):
    return f"{path.rstrip('/')}.index"


def write_index(spark, path, block_rows=BLOCK_ROWS, mode="errorifexists"):
    """Index the interval table at ``path``: (genome, chrom, file, block, rows, block_start, block_end, reach).

    One pass over four columns; rows of a block are combined before the shuffle. ``reach`` runs along the blocks of a
    contig, which are one row per ``block_rows`` records.
    """
    rows = spark.read.schema(_schema(spark, path)).option("basePath", path).parquet(literal_path(path)).select(
        "genome", "chrom", "start", "end", F.col("_metadata.file_path").alias("file"),
        F.expr(f"_metadata.row_index div {block_rows}").alias("block"))
    blocks = rows.groupBy("genome", "chrom", "file", "block").agg(
        F.count("*").alias("rows"), F.min("start").alias("block_start"), F.max("end").alias("block_end"))
    along = Window.partitionBy("genome", "chrom").orderBy("block_start", "file", "block")
    reach = F.max("block_end").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = blocks.withColumn("reach", reach).repartitionByRange("genome", "chrom", "block_start").sortWithinPartitions(
        "genome", "chrom", "block_start")
    placed.write.mode(mode).partitionBy("genome").parquet(index_path(path))


def _schema(spark, path):
    """The columns of a table; a genome is text, whatever it looks like as a folder name."""
    fields = spark.read.option("basePath", path).parquet(literal_path(path)).schema.fields
    return ", ".join(f"`{f.name}` {'string' if f.name == 'genome' else f.dataType.simpleString()}" for f in fields)


def _read(spark, path, files=None):
    reader = spark.read.schema(_schema(spark, path)).option("basePath", path)
    if files is None:
        return reader.parquet(literal_path(path))
    return reader.parquet(*files)


def _overlaps(start, end, from_, to):
    """Half-open spans that share a position; an empty span counts as the position it stands before."""
    end = F.greatest(end, start + 1)
    return (start < to) & (end > from_)


def region_files(spark, path, regions):
    """The files that hold a record of any of ``regions`` (genome, chrom, start, end), from the index alone.

    There are at most as many as the table has files.
    """
    index = spark.read.schema("chrom string, file string, block long, rows long, block_start long, block_end long, reach long, "
                              "genome string").parquet(literal_path(index_path(path)))
    wanted = regions.select("genome", "chrom", F.col("start").alias("_from"), F.greatest("end", F.col("start") + 1).alias("_to"))
    # ``reach`` grows along a contig, so its row groups before a region are skipped; block_end then decides.
    span = wanted.groupBy("genome", "chrom").agg(F.min("_from").alias("_least"), F.max("_to").alias("_most"))
    near = index.join(span, ["genome", "chrom"]).filter("reach >= _least and block_start < _most")
    tiles = F.sequence(F.expr(f"block_start div {TILE}"), F.expr(f"greatest(block_end, block_start) div {TILE}"))
    met = near.withColumn("_tile", F.explode(tiles)).join(
        wanted.withColumn("_tile", F.explode(F.expr(f"sequence(_from div {TILE}, (_to - 1) div {TILE})"))), ["genome", "chrom", "_tile"])
    hit = met.filter(_overlaps(F.col("block_start"), F.greatest("block_end", F.col("block_start") + 1), F.col("_from"), F.col("_to")))
    return [row["file"] for row in hit.select("file").distinct().orderBy("file").collect()]


def _as_paths(files):
    """Paths to load from the file addresses that Spark reports, in which special characters are escaped."""
    from urllib.parse import unquote

    return [literal_path(unquote(file)) for file in files]


def read_region(spark, path, genome, chrom, start, end):
    """The records of one region, from the files that hold any; those of other files are not opened."""
    region = spark.createDataFrame([(genome, chrom, start, end)], "genome string, chrom string, start long, end long")
    files = region_files(spark, path, region)
    if not files:
        return _read(spark, path).filter(F.lit(False))
    to = max(end, start + 1)
    # Plain comparisons first: Parquet skips row groups by them.
    rows = _read(spark, path, _as_paths(files)).filter(
        (F.col("genome") == genome) & (F.col("chrom") == chrom) & (F.col("start") < to) & (F.col("end") >= start))
    return rows.filter(_overlaps(F.col("start"), F.col("end"), F.lit(start), F.lit(to)))


def read_regions(spark, path, regions):
    """The records of many ``regions`` (genome, chrom, start, end, and any others), one row for each region and record that meet.

    Records and regions are joined by tile; a pair that shares several tiles is taken in the first of them. Region columns
    come with the prefix ``region_``.
    """
    files = region_files(spark, path, regions)
    rows = _read(spark, path, _as_paths(files)) if files else _read(spark, path).filter(F.lit(False))
    named = regions.select(*(F.col(c).alias(c if c in ("genome", "chrom") else f"region_{c}") for c in regions.columns))
    to = F.greatest("region_end", F.col("region_start") + 1)
    named = named.withColumn("_tile", F.explode(F.sequence(F.expr(f"region_start div {TILE}"), F.expr(
        f"(greatest(region_end, region_start + 1) - 1) div {TILE}"))))
    last = F.expr(f"greatest(`end` - 1, start) div {TILE}")
    tiled = rows.withColumn("_first", F.expr(f"start div {TILE}")).withColumn("_tile", F.explode(F.sequence("_first", last)))
    met = lookup_join(tiled, named, ["genome", "chrom", "_tile"], "inner")
    first = F.greatest("_first", F.expr(f"region_start div {TILE}"))
    return met.filter(_overlaps(F.col("start"), F.col("end"), F.col("region_start"), to) & (F.col("_tile") == first)).drop("_tile", "_first")
