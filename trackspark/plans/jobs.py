"""Whole jobs: from samplesheet rows and files to clean, catalogued tracks."""

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.names import basename, ensembl_genome, file_type, run_name
from ..operators import catalog as C
from ..operators import genes as GN
from ..operators import sizes as SZ
from ..operators.contigs import audit_missing, contig_aliases, harmonise_contigs, resolve_missing
from ..operators.intervals import check_bounds
from ..operators.lookup import fits_broadcast, lookup_join
from ..operators.scratch import land
from ..sources import records
from ..sources.logs import summarise_logs
from ..sources.tables import list_track_files, read_assembly_report
from ..sources.text import literal_path, resolve_files

TRACK = ["run", "genome"]


class Track(NamedTuple):
    """Records of one kind of track after cleaning; every input record is in one of the frames."""

    clean: DataFrame
    missing: DataFrame
    rejects: DataFrame
    counts: dict | None = None


def sorted_out(rows, sizes, on_missing="drop", allow_empty=True, on="genome", seen=()):
    """A ``Track`` of records that are matched, checked and written once, with the ``counts`` of that one write.

    ``counts`` has the records of ``input``, ``clean``, ``missing`` and ``rejects``, and what the observations ``seen``
    counted further up, such as header lines. Each frame reads its own folder of the written table.
    """
    if not fits_broadcast(contig_aliases(sizes, on)):
        rows = land(rows)  # the join will look for heavy keys first
    frame = F.when(~F.col("known"), "missing").when(F.col("reject_reason").isNotNull(), "rejects").otherwise("clean")
    tagged = check_bounds(harmonise_contigs(rows, sizes, on), allow_empty).withColumn("_frame", frame)
    found = Observation()
    of = {name: F.count_if(F.col("_frame") == name).alias(name) for name in ("clean", "missing", "rejects")}
    written = land(tagged.observe(found, F.count("*").alias("input"), *of.values()), by=["_frame"])
    counts = {name: n for part in (*seen, found) for name, n in part.get.items()}
    part = {name: written.filter(F.col("_frame") == name).drop("_frame") for name in of}
    if counts["missing"]:
        resolve_missing(part["missing"], on_missing, on)  # raises in error mode
    return Track(
        part["clean"].drop("reject_reason", "contig_size", "known"),
        audit_missing(part["missing"], on),
        part["rejects"].drop("known"),
        counts,
    )


def _cleaned(rows, sizes, on_missing, allow_empty, on):
    harmonised = harmonise_contigs(rows, sizes, on)
    tagged = check_bounds(resolve_missing(harmonised, on_missing, on), allow_empty)
    return Track(
        tagged.filter("reject_reason is null").drop("reject_reason", "contig_size"),
        audit_missing(harmonised, on),
        tagged.filter("reject_reason is not null"),
    )


def clean_intervals(rows, sizes, on_missing="drop", on="genome"):
    """Interval records on known contigs and within bounds."""
    return _cleaned(rows, sizes, on_missing, True, on)


def clean_signal(rows, sizes, on_missing="drop", on="genome"):
    """Signal records on known contigs, within bounds and not empty."""
    return _cleaned(rows, sizes, on_missing, False, on)


def attach_files(rows, files, columns):
    """Give each record the ``columns`` of the sheet row of its file; ``files`` comes from ``resolve_files``.

    A record of a file that no sheet row names ends the job: none is left out.
    """
    known = files.select("path", *columns, F.lit(True).alias("_known")).distinct()
    joined = lookup_join(rows, known, ["path"], "left")
    # As a filter, the check stays however few columns the caller goes on with.
    stray = F.raise_error(F.concat(F.lit("no samplesheet row names the file "), F.col("path")))
    return joined.filter(F.when(F.col("_known"), F.lit(True)).otherwise(stray)).drop("_known")


def _sheet_files(spark, sheet, kind, sizes, on_unmatched):
    """(paths to read, their files with run and genome) of one file type; (None, None) where the sheet has none.

    A samplesheet has one row per track file; its paths are collected once, as Spark's reader takes them as a list.
    """
    chosen = sheet.filter(F.col("file_type") == kind).select("path", "run", "genome", "file_type")
    if not chosen.limit(1).count():
        return None, None
    chosen = land(C.attach_sizes(chosen, sizes, on_unmatched=on_unmatched).select("path", "run", "genome"))
    paths = [row["path"] for row in chosen.select("path").distinct().collect()]
    return [literal_path(path) for path in paths], resolve_files(spark, chosen, paths)


def bed_job(spark, sheet, sizes, on_missing="drop", sep="whitespace", on_unmatched="error"):
    """BED files of a samplesheet to clean intervals. All files are read in one plan, once, and counted as they are written."""
    paths, files = _sheet_files(spark, sheet, "bed", sizes, on_unmatched)
    if not paths:
        return None
    seen = Observation()
    rows = attach_files(records.read_bed(spark, paths, sep, seen), files, TRACK)
    return sorted_out(rows, sizes, on_missing, seen=[seen])


def bedgraph_job(spark, sheet, sizes, on_missing="drop", on_unmatched="error"):
    """bedGraph files of a samplesheet to clean signal, with the number of header lines among the counts.

    ``write_signal`` sorts and summarises it and reports the records that overlap.
    """
    paths, files = _sheet_files(spark, sheet, "bedgraph", sizes, on_unmatched)
    if not paths:
        return None
    seen = Observation()
    rows = attach_files(records.read_bedgraph(spark, paths, seen), files, TRACK)
    return sorted_out(rows, sizes, on_missing, allow_empty=False, seen=[seen])


class Genes(NamedTuple):
    track: Track
    bad_models: DataFrame


def gff3_job(
    spark, sheet, sizes, on_missing="drop", partitions=None, keys=("genome", "run", "path"), on_unmatched="error"
):
    """GFF3 files of a samplesheet to bigGenePred rows on known contigs.

    Features are linked within ``keys``: within a file, or with ``("genome", "run")``
    over all the files of a run.
    """
    paths, files = _sheet_files(spark, sheet, "gff3", sizes, on_unmatched)
    if not paths:
        return None
    # Text is parsed once; the models go over the features several times.
    seen = Observation()
    fields = land(attach_files(records.read_gff3_fields(spark, paths, partitions, seen=seen), files, TRACK))
    return gene_rows(records.with_attributes(fields), sizes, on_missing, keys, seen=[seen])


def gene_rows(features, sizes, on_missing="drop", keys=("genome", "path"), on="genome", seen=()):
    """GFF3 features to bigGenePred rows on known contigs and within bounds; ``counts`` are of models."""
    models, bad = GN.gene_models(features, keys)
    rows = GN.to_biggenepred(models, extra=keys)
    spans = rows.withColumnRenamed("chromStart", "start").withColumnRenamed("chromEnd", "end")
    track = sorted_out(spans, sizes, on_missing, True, on, seen)

    def named(df):
        return df.withColumnRenamed("start", "chromStart").withColumnRenamed("end", "chromEnd")

    return Genes(Track(named(track.clean), track.missing, named(track.rejects), track.counts), bad)


def sizes_job(spark, sheet, tables=None, sequences=None, force_ucsc=True):
    """Chromosome sizes of every genome of a samplesheet: (genome, name, size).

    A genome with an assembly report uses it; others take their rows from
    ``tables`` (genome, name, size), and failing that from ``sequences``. They
    are landed, since every track of the run is matched against them.
    """
    with_report, _ = SZ.split_size_sources(sheet)
    reports = with_report.select("genome", F.col("assembly_report").alias("path"))
    paths = [row["path"] for row in reports.select("path").distinct().collect()]
    frames = []
    if paths:
        body = attach_files(
            read_assembly_report(spark, [literal_path(p) for p in paths]), resolve_files(spark, reports, paths), ["genome"]
        ).drop("path")
        frames.append(SZ.chrom_sizes_from_reports(body, _seqids(spark, sheet, with_report), force_ucsc).select(
            "genome", "name", "size", F.lit("report").alias("source")
        ))
    for rows, source in ((tables, "ucsc"), (sequences, "fasta")):
        if rows is not None:
            frames.append(rows.select("genome", "name", "size", F.lit(source).alias("source")))
    if not frames:
        raise ValueError("no source of chromosome sizes")
    every = land(C.union_tracks(*frames))
    best = SZ.pick_sizes_source(every.select("genome", "source").distinct())
    return lookup_join(every, best, ["genome", "source"], "left_semi").drop("source")


def _seqids(spark, sheet, with_report):
    """Sequence names of the representative annotation of each genome that has a report."""
    chosen = lookup_join(SZ.representative_gff(sheet), with_report.select("genome"), ["genome"], "left_semi")
    chosen = chosen.filter("path != ''").select("genome", "path")
    paths = [row["path"] for row in chosen.select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], "genome string, seqid string")
    lines = records.read_gff3(spark, [literal_path(p) for p in paths])
    return SZ.gff_seqids(attach_files(lines, resolve_files(spark, chosen, paths), ["genome"]))


# What each file type becomes, and the extension of a converted file.
TRACK_TYPES = {"bed": "bigbed", "bedgraph": "bigwig", "bigbed": "bigbed", "bigwig": "bigwig", "gff3": "bigbed"}
CONVERTED = {"bed": ".bb", "bedgraph": ".bw", "gff3": ".bb"}


def track_files(sheet):
    """The tracks a samplesheet leads to: (path, track_type) with its other columns.

    A converted file is named after its run; one that is already in its final form
    is taken as it is. Rows of an unknown type lead to none.
    """
    kind = F.col("file_type")
    track_type, extension = F.lit(None).cast("string"), F.lit(None).cast("string")
    for known, becomes in TRACK_TYPES.items():
        track_type = F.when(kind == known, becomes).otherwise(track_type)
    for known, ending in CONVERTED.items():
        extension = F.when(kind == known, ending).otherwise(extension)
    return (
        sheet.withColumnRenamed("path", "source_path")
        .withColumn("track_type", track_type)
        .withColumn("path", F.coalesce(F.concat("run", extension), "source_path"))
        .filter("track_type is not null")
    )


def directory_sheet(spark, roots, genome, glob=None, hub=None):
    """Samplesheet rows of the track files under ``roots``."""
    return sheet_rows(list_track_files(spark, roots, glob), genome, hub)


def sheet_rows(files, genome, hub=None):
    """Samplesheet rows of track files (path): run and file type come from each file's name."""
    return files.withColumn("_name", basename("path")).select(
        run_name("_name").alias("run"), file_type("_name").alias("file_type"), "path",
        F.lit(genome).alias("genome"), F.lit("").alias("assembly_report"), F.lit(hub).cast("string").alias("hub"),
    ).filter("file_type != 'unknown'")


def catalog_job(files, hub_name=None, metadata=None, sample_pattern=None, annotation_pattern=None, ensembl=False):
    """Track files (path, track_type, genome, hub) to catalog rows with display parameters.

    Genomes get their Ensembl names with ``ensembl``. ``publish`` refuses two tracks of one name in a hub.
    """
    tracks = C.with_track_fields(C.with_hub_key(files, hub_name), sample_pattern, annotation_pattern)
    if metadata is not None:
        tracks = C.apply_sample_metadata(tracks, metadata)
    tracks = C.track_params(tracks, hub_prefix="hub", ensembl=ensembl)
    if ensembl:
        tracks = tracks.withColumn("genome", ensembl_genome("genome"))
    return C.with_composite(tracks, ensembl)


def aggregate_job(*catalogs):
    """Several catalogs to one multi-assembly table."""
    return C.multi_assembly(*catalogs)


def logs_job(spark, paths):
    return summarise_logs(spark, paths)
