"""Lines of text files, with their file and their order."""

import os
import re

from pyspark.sql import functions as F

from ..functions.gff import percent_decode
from ..operators.scratch import land


def clean_path(path, encoded=False):
    """One spelling for local paths; paths with another scheme keep it."""
    path = F.col(path) if isinstance(path, str) else path
    if encoded:
        path = percent_decode(path)
    return F.regexp_replace(path, "^file:/+", "/")


def literal_path(path):
    """A path with its pattern characters escaped: a samplesheet names files, not patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def plain_path(path):
    """A path without detours: absolute, one slash at a time, ``..`` resolved, no ``file:`` in front."""
    scheme, colon, rest = path.partition("://")
    if colon and scheme != "file":
        host, slash, inner = rest.partition("/")
        return f"{scheme}://{host}" + os.path.normpath(re.sub("^/+", "/", slash + inner)) if slash else path
    return os.path.abspath(re.sub("^(file:)?/+", "/", path))


def _folders(file):
    """A file and all folders it is in."""
    parts = F.split(file, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def resolve_files(spark, rows, paths=None):
    """``rows`` with ``path`` as Spark spells the files there: one row per file of a directory.

    Relative paths, doubled slashes and directories are resolved, so that records meet their rows however a path was
    written. All paths are listed together, and files meet their rows in a join; only paths that this leaves without a file, empty ones and
    those that a store spells in its own way, are listed one by one. A path without a file raises. ``paths`` may hand in
    the distinct paths of ``rows``, which Spark's reader needs as a list.
    """
    if paths is None:
        paths = [row["path"] for row in rows.select("path").distinct().collect()]
    if not paths:
        return rows
    named = spark.createDataFrame([(path, plain_path(path)) for path in paths], "path string, _plain string")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = reader.load([literal_path(path) for path in paths]).select(clean_path("path").alias("file"))
    inside = listed.distinct().select("file", F.explode(_folders(F.col("file"))).alias("_plain"))
    met = land(named.join(inside, "_plain").select("path", "file").distinct())
    resolved = rows.join(met, "path")
    odd = []
    for row in named.join(met, "path", "left_anti").collect():
        files = spark.read.format("text").load(literal_path(row["path"])).inputFiles()
        if not files:
            raise FileNotFoundError(f"no files at {row['path']}")
        odd += [(row["path"], file) for file in files]
    if odd:
        rest = spark.createDataFrame(odd, "path string, file string").withColumn("file", clean_path("file", encoded=True))
        resolved = resolved.unionByName(rows.join(rest, "path"))
    return resolved.withColumn("path", F.col("file")).drop("file")


def read_lines(spark, paths):
    """(path, value) for each line; order is not kept."""
    return spark.read.text(paths).select(clean_path("_metadata.file_path", encoded=True).alias("path"), "value")


def read_ordered_lines(spark, paths):
    """(path, block, line, value): within a file, (block, line) follows the file's order.

    ``block`` is the byte at which the split begins and ``line`` grows along it,
    so order is known without one task reading a whole file.
    """
    return spark.read.text(paths).select(
        clean_path("_metadata.file_path", encoded=True).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
