"""Record shapes shared by sources, operators and sinks.

All coordinates are 0-based and half-open once a record has been read.
"""

from pyspark.sql import types as T

SIZES = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("size", T.LongType()),
])

# The optional BED columns after chrom, start and end, in file order.
BED_TAIL = [
    ("name", "string"),
    ("score", "int"),
    ("strand", "string"),
    ("thick_start", "bigint"),
    ("thick_end", "bigint"),
    ("item_rgb", "string"),
    ("block_count", "int"),
    ("block_sizes", "array<bigint>"),
    ("block_starts", "array<bigint>"),
]

# The 20 columns of a bigGenePred row (BED12+8), in file order.
BIG_GENE_PRED = [
    ("chrom", "string"),
    ("chromStart", "bigint"),
    ("chromEnd", "bigint"),
    ("name", "string"),
    ("score", "bigint"),
    ("strand", "string"),
    ("thickStart", "bigint"),
    ("thickEnd", "bigint"),
    ("reserved", "bigint"),
    ("blockCount", "int"),
    ("blockSizes", "array<int>"),
    ("chromStarts", "array<int>"),
    ("name2", "string"),
    ("cdsStartStat", "string"),
    ("cdsEndStat", "string"),
    ("exonFrames", "array<int>"),
    ("type", "string"),
    ("geneName", "string"),
    ("geneName2", "string"),
    ("geneType", "string"),
]

# File types a samplesheet row may carry.
FILE_TYPES = ["bed", "bedgraph", "bigbed", "bigwig", "gff3"]
