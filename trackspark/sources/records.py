"""Interval, signal and gene records from text."""

from pyspark.sql import functions as F

from ..functions import gff as G
from ..functions import values as V
from ..schemas import BED_TAIL, BIG_GENE_PRED
from .text import read_lines

# A bedGraph line that starts with one of these is a header.
BEDGRAPH_HEADER = "^(track|browser|#)"


def _others(lines):
    return [c for c in lines.columns if c != "value"]


def parse_bed(lines, sep="whitespace"):
    """(chrom, start, end, rest) from a ``value`` column; ``rest`` keeps the later fields as text.

    No header line is recognised: ``track ...`` is a record on contig ``track``.
    """
    split = {"whitespace": V.whitespace_fields, "tab": V.tab_fields}[sep]
    fields = F.col("_fields")
    return lines.withColumn("_fields", split("value")).select(
        *_others(lines),
        F.get(fields, F.lit(0)).alias("chrom"),
        V.number(F.get(fields, F.lit(1))).alias("start"),
        V.number(F.get(fields, F.lit(2))).alias("end"),
        F.slice(fields, F.lit(4), F.greatest(F.size(fields) - 3, F.lit(0))).alias("rest"),
    )


def typed_bed(df):
    """Typed columns for the optional BED fields held in ``rest``."""
    typed = []
    for position, (name, kind) in enumerate(BED_TAIL):
        text = F.get("rest", F.lit(position))
        if kind.startswith("array"):
            typed.append(V.number_list(text).alias(name))
        else:
            typed.append(text.try_cast(kind).alias(name))
    return df.select("*", *typed)


def spread_gzip(lines, paths, partitions=None):
    """``lines`` dealt out evenly where a gzipped file is among ``paths``, by default over as many parts as a shuffle has.

    A gzipped file is one split, so one task decodes it; the fields are then parsed by many.
    """
    named = [paths] if isinstance(paths, str) else paths
    if partitions is None and any(path.endswith(".gz") for path in named):
        partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(partitions) if partitions else lines


def read_bed(spark, paths, sep="whitespace", seen=None):
    """BED records of plain or gzipped files; an Observation ``seen`` counts their ``lines``."""
    lines = spread_gzip(read_lines(spark, paths), paths)
    if seen is not None:
        lines = lines.observe(seen, F.count("*").alias("lines"))
    return parse_bed(lines, sep)


def parse_bedgraph(lines, seen=None):
    """(chrom, start, end, value) from a ``value`` column of text; header lines are left out.

    An Observation ``seen`` counts ``lines`` and ``headers`` as they pass.
    """
    fields = F.col("_fields")
    header = F.col("value").rlike(BEDGRAPH_HEADER)
    if seen is not None:
        lines = lines.observe(seen, F.count("*").alias("lines"), F.count_if(header).alias("headers"))
    return (
        lines.filter(~header)
        .withColumn("_fields", V.whitespace_fields("value"))
        .select(
            *_others(lines),
            F.get(fields, F.lit(0)).alias("chrom"),
            V.number(F.get(fields, F.lit(1))).alias("start"),
            V.number(F.get(fields, F.lit(2))).alias("end"),
            V.number(F.get(fields, F.lit(3)), "double").alias("value"),
        )
    )


def read_bedgraph(spark, paths, seen=None):
    return parse_bedgraph(spread_gzip(read_lines(spark, paths), paths), seen)


def parse_gff3(lines, dropped_attribute=None):
    """GFF3 features from a ``value`` column, with the attributes that link them."""
    return with_attributes(gff3_fields(lines, dropped_attribute))


def gff3_fields(lines, dropped_attribute=None, seen=None):
    """The nine fields of GFF3 lines; positions become 0-based and half-open.

    Comments, and lines without nine fields (an embedded sequence section), are
    left out. ``dropped_attribute`` names an attribute to strip first. An Observation ``seen`` counts ``lines``, ``comments``
    and ``malformed`` lines as they pass.
    """
    fields, others = F.col("_fields"), _others(lines)
    comment = F.col("value").startswith("#")
    if seen is None:
        lines = lines.filter(~comment)
    lines = lines.withColumn("_split", F.when(~comment, V.tab_fields("value")))
    nine = F.size("_split") == 9
    if seen is not None:
        lines = lines.observe(seen, F.count("*").alias("lines"), F.count_if(comment).alias("comments"),
                              F.count_if(~comment & ~nine).alias("malformed"))

    def field(position):
        return F.get(fields, F.lit(position))

    attributes = G.without_attribute(field(8), dropped_attribute) if dropped_attribute else field(8)
    return (
        # A filter on the fields would go below the split and split every line again.
        lines.select(*others, F.explode(F.when(nine, F.array("_split"))).alias("_fields"))
        .select(
            *others,
            field(0).alias("chrom"),
            field(1).alias("source"),
            field(2).alias("type"),
            (V.number(field(3)) - 1).alias("start"),
            V.number(field(4)).alias("end"),
            V.number(F.nullif(field(5), F.lit(".")), "double").alias("score"),
            field(6).alias("strand"),
            V.number(F.nullif(field(7), F.lit(".")), "int").alias("phase"),
            attributes.alias("attributes"),
        )
    )


def with_attributes(features):
    """Add ``id``, ``name`` and ``parents``, read from ``attributes``.

    Apply this after landing: only the rows and keys a query needs are then searched.
    """
    return features.select(
        "*",
        G.attribute("attributes", "ID").alias("id"),
        G.attribute("attributes", "Name").alias("name"),
        G.attribute_list("attributes", "Parent").alias("parents"),
    )


def read_gff3_fields(spark, paths, partitions=None, dropped_attribute="AdditionalSources", seen=None):
    """The fields of plain or gzipped GFF3 files.

    The lines of gzipped files are spread over ``partitions`` before parsing.
    """
    return gff3_fields(spread_gzip(read_lines(spark, paths), paths, partitions), dropped_attribute, seen)


def read_gff3(spark, paths, partitions=None, dropped_attribute="AdditionalSources"):
    """Features of plain or gzipped GFF3 files."""
    return with_attributes(read_gff3_fields(spark, paths, partitions, dropped_attribute))


def parse_biggenepred(lines):
    """The 20 tab-separated columns of BED12+8 from a ``value`` column."""
    typed = []
    for position, (name, kind) in enumerate(BIG_GENE_PRED):
        text = F.get("_fields", F.lit(position))
        if kind.startswith("array"):
            typed.append(V.number_list(text, "int").alias(name))
        else:
            typed.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return lines.withColumn("_fields", V.tab_fields("value")).select(*_others(lines), *typed)


def read_biggenepred(spark, paths):
    return parse_biggenepred(read_lines(spark, paths))
