"""Small tables that steer a run: samplesheet, sample metadata, sizes, file listings."""

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..functions.names import header_key
from ..functions.values import json_map, number, tab_fields, unreadable_json, whitespace_fields
from ..operators.dedupe import dedupe
from ..operators.lookup import lookup_join
from .text import clean_path, read_ordered_lines

log = logging.getLogger(__name__)

# Columns of a samplesheet and the names they get here.
SAMPLESHEET = {
    "Run": "run",
    "FileType": "file_type",
    "Path": "path",
    "Genome": "genome",
    "AssemblyReport": "assembly_report",
    "Hub": "hub",
}

# Optional columns of a sample-metadata sheet.
METADATA = ["short_label", "long_label", "color", "visibility", "priority", "additional_params"]

# Name columns of an assembly report, in order of preference.
NAME_COLUMNS = ["ucsc-style-name", "sequence-name", "refseq-accn", "genbank-accn"]
LENGTH_COLUMN = "sequence-length"


def samplesheet_rows(sheet):
    """Samplesheet columns under our names; ``Hub`` may be absent, and so may ``AssemblyReport``."""
    missing = [c for c in ("Run", "FileType", "Path", "Genome") if c not in sheet.columns]
    if missing:
        raise ValueError(f"samplesheet lacks the columns {', '.join(missing)}")
    absent = {"Hub": F.lit(None).cast("string"), "AssemblyReport": F.lit("")}
    return sheet.select(*[
        (F.col(column) if column in sheet.columns else absent[column]).alias(ours)
        for column, ours in SAMPLESHEET.items()
    ]).withColumn("assembly_report", F.coalesce("assembly_report", F.lit("")))


def read_samplesheet(spark, path):
    return samplesheet_rows(spark.read.csv(path, header=True))


def _named_samples(sheet):
    if "sample_id" not in sheet.columns:
        raise ValueError("sample metadata lacks the column sample_id")
    return sheet.filter(F.trim("sample_id") != "")


def metadata_warnings(sheet):
    """(sample_id, additional_params, row_order) of the rows whose parameters hold something that is no JSON object."""
    named = _named_samples(sheet)
    if "additional_params" not in sheet.columns:
        named = named.withColumn("additional_params", F.lit(None).cast("string"))
    return named.filter(unreadable_json("additional_params")).select("sample_id", "additional_params", "row_order")


def metadata_rows(sheet, seen=None):
    """Sample metadata with defaults; the row with the greatest ``row_order`` wins per sample.

    An absent label column falls back to the sample; a present but empty one stays empty. Parameters that cannot be read
    count as empty; ``metadata_warnings`` lists them, and an Observation ``seen`` counts ``rows`` and ``unreadable_params``.
    """
    sheet = _named_samples(sheet)

    def column(name, default):
        return (F.coalesce(F.col(name), F.lit("")) if name in sheet.columns else default).alias(name)

    params = F.col("additional_params") if "additional_params" in sheet.columns else F.lit(None).cast("string")
    if seen is not None:
        sheet = sheet.observe(seen, F.count("*").alias("rows"), F.count_if(unreadable_json(params)).alias("unreadable_params"))
    rows = sheet.select(
        "sample_id",
        column("short_label", F.col("sample_id")),
        column("long_label", F.col("sample_id")),
        column("color", F.lit("")),
        column("visibility", F.lit("")),
        column("priority", F.lit("1")),
        params.alias("additional_params"),
        "row_order",
    )
    last = dedupe(rows, ["sample_id"], keep="last", order="row_order").drop("row_order")
    return last.withColumn("additional_params", json_map("additional_params"))


def read_metadata_sheet(spark, path):
    """The columns of a sample sheet, and ``row_order``, its rows' order over all files."""
    sheet = spark.read.csv(path, header=True, escape='"')
    order = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return sheet.select("*", order.alias("row_order"))


def read_sample_metadata(spark, path, seen=None):
    return metadata_rows(read_metadata_sheet(spark, path), seen)


def read_chrom_sizes(spark, path, genome=None):
    """(genome, name, size) from the first two blank-separated fields of each line; a size that is no number is null."""
    fields = whitespace_fields("value")
    lines = spark.read.text(path).filter(F.btrim("value", F.lit(" \t\r")) != "")
    return lines.select(
        F.lit(genome).cast("string").alias("genome"), F.get(fields, F.lit(0)).alias("name"),
        number(F.get(fields, F.lit(1))).alias("size"),
    )


def parse_assembly_report(lines, keys=("path",)):
    """Body rows of assembly reports, by the last header of each report.

    ``lines`` holds ``keys``, ``block``, ``line`` and ``value``. Each body row gets
    ``fields``, the position of the named columns in ``places`` (null where the
    report has none) and ``position``, its place in the file.
    """
    keys = list(keys)
    text = F.col("value")
    is_comment = text.startswith("#")
    is_header = (
        is_comment
        & text.contains("Sequence-Name")
        & (text.contains("Sequence-Length") | F.lower(text).contains("sequence length"))
    )
    position = F.struct("block", "line")
    bare = F.regexp_replace(text, r"^#+|\s+\z", "")
    bare = F.regexp_replace(bare, r"^\s+", "")
    labels = F.when(bare.contains("\t"), F.split(bare, "\t")).otherwise(F.split(bare, r"\s+"))

    def place(label):
        backwards = F.array_position(F.reverse("labels"), label)
        return F.when(backwards > 0, F.size("labels") - backwards).cast("int")

    columns = [*NAME_COLUMNS, LENGTH_COLUMN]
    headers = (
        lines.filter(is_header)
        .groupBy(*keys)
        .agg(F.max_by(labels, position).alias("labels"))
        .withColumn("labels", F.transform("labels", header_key))
        .select(*keys, F.struct(*[place(c).alias(c.replace("-", "_")) for c in columns]).alias("places"))
    )
    body = lines.filter(~is_comment).select(*keys, position.alias("position"), tab_fields("value").alias("fields"))
    return lookup_join(body, headers, keys, "left")


def read_assembly_report(spark, paths):
    return parse_assembly_report(read_ordered_lines(spark, paths))


def list_track_files(spark, roots, glob=None, recursive=True):
    """Paths of the files under ``roots``, sorted; contents are not read.

    A pattern without a match is a warning, not an error.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    paths = []
    for root in [roots] if isinstance(roots, str) else roots:
        try:
            found = reader.load(root).inputFiles()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            found = []
        if not found:
            log.warning("no track files match %s", root)
        paths += found
    # The listing is Spark's own; a scan would leave out empty files.
    listed = spark.createDataFrame([(path,) for path in paths], "path string")
    return listed.select(clean_path("path", encoded=True).alias("path")).distinct().orderBy("path")
