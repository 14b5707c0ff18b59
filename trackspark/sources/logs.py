"""Counts over log files."""

from pyspark.sql import functions as F


def summarise_logs(spark, paths):
    """One row: number of files and of lines. Empty files count as files."""
    lines = spark.read.text(paths)
    files = len(lines.inputFiles())
    return lines.agg(F.lit(files).cast("bigint").alias("files"), F.count("*").alias("lines"))


def summarise_lines(lines, file="path"):
    """The same summary for lines that are already rows."""
    per_file = lines.groupBy(file).agg(F.count("*").alias("lines"))
    return per_file.agg(F.count("*").alias("files"), F.sum("lines").alias("lines"))
