"""Chromosome sizes of each genome: from assembly reports, tables or sequences."""

from pyspark.sql import functions as F

from ..functions.names import chrize
from ..functions.values import number
from ..sources.tables import LENGTH_COLUMN, NAME_COLUMNS
from .lookup import lookup_join
from .scratch import land

# Sources of chromosome sizes, best first.
SIZE_SOURCES = ["report", "ucsc", "fasta"]

ACCESSION = "^(GCA|GCF)_"
UCSC_NAMES = "ucsc-style-name"
SEQUENCE_NAMES = "sequence-name"


def _place(column):
    return F.col(f"places.{column.replace('-', '_')}")


def _is_name(value):
    return (value != "") & (F.lower(value) != "na")


def split_size_sources(genomes):
    """Genomes with an assembly report, and those to look up by their database name.

    Accessions without a report have no such name and are in neither frame.
    """
    rows = genomes.select("genome", F.coalesce("assembly_report", F.lit("")).alias("assembly_report")).distinct()
    return (
        rows.filter("assembly_report != ''"),
        rows.filter((F.col("assembly_report") == "") & ~F.col("genome").rlike(ACCESSION)).select("genome"),
    )


def representative_gff(files):
    """The first annotation path of each genome, ``''`` where it has none."""
    found = F.min(F.when(F.col("file_type") == "gff3", F.nullif("path", F.lit(""))))
    return files.groupBy("genome").agg(F.coalesce(found, F.lit("")).alias("path"))


def gff_seqids(gff, on="genome"):
    """Distinct sequence names of the features of each genome."""
    return gff.select(on, F.trim("chrom").alias("seqid")).filter("seqid != ''").distinct()


def name_scores(report, seqids, on="genome"):
    """Per name column of a report: distinct names, and how many are among ``seqids``."""
    columns = F.array(*[
        F.struct(
            F.lit(rank).alias("rank"),
            _place(column).alias("place"),
            F.get("fields", _place(column)).alias("name"),
        )
        for rank, column in enumerate(NAME_COLUMNS)
    ])
    names = (
        report.select(on, F.inline(columns))
        .filter("place is not null")
        .select(on, "rank", F.when(_is_name(F.col("name")), F.col("name")).alias("name"))
        .distinct()
    )
    known = seqids.select(on, F.col("seqid").alias("name"), F.lit(1).alias("hit")).distinct()
    return (
        names.join(known, [on, "name"], "left")
        .groupBy(on, "rank")
        .agg(F.count("name").alias("names"), F.count("hit").alias("score"))
    )


def choose_name_column(report, seqids, force_ucsc=True, on="genome"):
    """(genome, chosen): the name column of each report that suits its annotation best.

    The column with most names among the sequence names wins; ties go to the
    sequence name, then by preference. With ``force_ucsc`` a non-empty UCSC column
    wins unless another scores higher.
    """
    scores = name_scores(report, seqids, on)
    is_sequence_name = F.col("rank") == NAME_COLUMNS.index(SEQUENCE_NAMES)
    is_ucsc = F.col("rank") == NAME_COLUMNS.index(UCSC_NAMES)
    best = scores.groupBy(on).agg(
        F.max_by("rank", F.struct("score", is_sequence_name, -F.col("rank"))).alias("best"),
        F.max("score").alias("top"),
        F.max(F.when(is_ucsc & (F.col("names") > 0), F.col("score"))).alias("ucsc_score"),
    )
    annotated = seqids.groupBy(on).agg(F.count("*").alias("seqids"))
    labels = F.array(*[F.lit(c) for c in NAME_COLUMNS])
    prefer_ucsc = F.lit(force_ucsc) & F.col("ucsc_score").isNotNull() & (
        F.col("seqids").isNull() | (F.col("ucsc_score") >= F.col("top"))
    )
    return best.join(annotated, on, "left").select(
        on, F.when(prefer_ucsc, F.lit(UCSC_NAMES)).otherwise(F.get(labels, F.col("best"))).alias("chosen")
    )


def chrom_sizes_from_reports(report, seqids, force_ucsc=True, on="genome"):
    """(genome, name, size) from the body rows of assembly reports.

    A row whose chosen name is missing falls back to its sequence name; a report
    without a usable header is read by position. The first row of a name wins.
    """
    chosen = land(choose_name_column(report, seqids, force_ucsc, on))  # one row per genome
    rows = lookup_join(report.filter(F.size("fields") >= 2), chosen, [on], "left")

    fields = F.col("fields")
    name_place = F.coalesce(*[
        F.when(F.col("chosen") == column, _place(column)) for column in NAME_COLUMNS
    ])
    by_header = (
        F.col("chosen").isNotNull()
        & (name_place < F.size(fields))
        & (_place(LENGTH_COLUMN) < F.size(fields))
    )
    chosen_name = F.get(fields, name_place)
    named = F.when(
        _is_name(chosen_name) | _place(SEQUENCE_NAMES).isNull(), chosen_name
    ).otherwise(F.get(fields, _place(SEQUENCE_NAMES)))
    last, before_last = F.element_at(fields, -1), F.element_at(fields, -2)
    positional = F.when(before_last.rlike(r"^\d+\z"), before_last).otherwise(last)
    by_header = F.coalesce(by_header, F.lit(False))
    raw = F.when(by_header, named).otherwise(F.get(fields, F.lit(0)))
    length = F.when(by_header, F.get(fields, _place(LENGTH_COLUMN))).otherwise(positional)
    plain = F.lit(force_ucsc) & (F.col("chosen").isNull() | (F.col("chosen") != UCSC_NAMES))
    return (
        rows.select(
            on,
            "position",
            F.when(plain, chrize(raw)).otherwise(raw).alias("name"),
            number(length).alias("size"),
        )
        .filter(_is_name(F.col("name")) & F.col("size").isNotNull())
        .groupBy(on, "name")
        .agg(F.min_by("size", "position").alias("size"))
    )


def pick_sizes_source(sources, on="genome"):
    """The best source of chromosome sizes of each genome; its row is kept whole."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SIZE_SOURCES]), F.col("source"))
    rank = F.when(rank > 0, rank).otherwise(len(SIZE_SOURCES) + 1)
    others = [c for c in sources.columns if c != on]
    return (
        sources.groupBy(on)
        .agg(F.min_by(F.struct(*others), F.struct(rank, *others)).alias("_best"))
        .select(on, "_best.*")
    )
