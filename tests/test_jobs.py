"""Whole jobs over files, and the sinks."""

import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackspark.operators.catalog import UnmatchedGenomeError
from trackspark.operators.contigs import EmptySizesError
from trackspark.plans import jobs
from trackspark.sinks import tracks as sinks
from trackspark.sources import records, tables

REPORT = "# Sequence-Name\tRole\tGenBank-Accn\tRefSeq-Accn\tSequence-Length\tUCSC-style-name\n1\tx\tC1\tN1\t1000\tna\nMT\tx\tC2\tN2\t90\tna\n"
GFF = "1\ts\tgene\t1\t500\t.\t+\t.\tID=g;Name=G\n1\ts\tmRNA\t1\t500\t.\t+\t.\tID=t;Parent=g\n1\ts\texon\t11\t60\t.\t+\t.\tParent=t\n1\ts\texon\t101\t160\t.\t+\t.\tParent=t\n9\ts\tgene\t1\t50\t.\t-\t.\tID=h\n9\ts\texon\t1\t50\t.\t-\t.\tParent=h\n"


@pytest.fixture(scope="module")
def sheet(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")

    def write(name, text):
        (folder / name).write_text(text)
        return str(folder / name)

    bed = write("one bed.bed", "1\t0\t10\ta\nchr1\t990\t1001\tb\nM\t1\t2\tc\nnope\t1\t2\td\n")
    bed2 = write("two.bed", "chr2\t3\t4\n1\t3\t4\n")
    graph = write("x.bedgraph", "track\n1\t0\t10\t1\n1\t5\t20\t2\n1\t20\t20\t3\n2\t0\t5\t1\n")
    gff = write("a.gff3", GFF)
    report = write("rep.txt", REPORT)
    path = write(
        "sheet.csv",
        "Run,FileType,Path,Genome,AssemblyReport,Hub\n"
        f"r1,bed,{bed},gA,{report},h1\nr2,bed,{bed2},gB,,\nr3,bedgraph,{graph},gA,{report},h1\n"
        f"r4,gff3,{gff},gA,{report},\nr5,bigwig,/d/r5_x.bw,gA,{report},h1\nr6,oddball,/d/z,gB,,\n",
    )
    return tables.read_samplesheet(spark, path)


@pytest.fixture(scope="module")
def sizes(spark, sheet):
    table = spark.createDataFrame([("gB", "2", 50), ("gB", "chr1", 9), ("gA", "ignored", 1)], "genome string, name string, size bigint")
    fasta = spark.createDataFrame([("gB", "zz", 1), ("gC", "c", 3)], "genome string, name string, size bigint")
    return jobs.sizes_job(spark, sheet, tables=table, sequences=fasta)


def test_sizes_prefer_reports(sizes):
    assert rows(sizes) == [
        ("gA", "chr1", 1000), ("gA", "chrM", 90), ("gB", "2", 50), ("gB", "chr1", 9), ("gC", "c", 3),
    ]


def test_bed_job(spark, sheet, sizes):
    track = jobs.bed_job(spark, sheet, sizes)
    assert rows(track.clean, "genome", "run", "chrom", "start", "end") == [
        ("gA", "r1", "chr1", 0, 10), ("gA", "r1", "chrM", 1, 2), ("gB", "r2", "2", 3, 4), ("gB", "r2", "chr1", 3, 4),
    ]
    assert rows(track.missing) == [("gA", "nope", 1)]
    assert rows(track.rejects, "start", "reject_reason") == [(990, "end_past_contig")]


def test_files_without_sizes_raise(spark, sheet, sizes):
    with pytest.raises(UnmatchedGenomeError, match="gB"):
        jobs.bed_job(spark, sheet, sizes.filter("genome = 'gA'"))


def test_bedgraph_job_and_its_sink(spark, sheet, sizes, tmp_path):
    track = jobs.bedgraph_job(spark, sheet, sizes)
    assert rows(track.clean, "chrom", "start", "end", "value") == [("chr1", 0, 10, 1.0), ("chr1", 5, 20, 2.0)]
    assert rows(track.rejects, "reject_reason") == [("end_before_start",)]
    out = str(tmp_path / "signal")
    sinks.write_signal(track.clean, out, [10, 40])
    assert rows(spark.read.parquet(f"{out}/overlaps"), "start", "end", "copies") == [(5, 20, 1)]
    with pytest.raises(sinks.OverlapError, match="overlap"):
        sinks.write_signal(track.clean, str(tmp_path / "strict"), [10, 40], on_overlap="error")
    assert rows(spark.read.parquet(f"{out}/summaries"), "reduction", "bin", "covered", "total") == [
        (10, 0, 15, 20.0), (10, 1, 10, 20.0), (40, 0, 25, 40.0),
    ]


def test_gff3_job_and_its_sinks(spark, sheet, sizes, tmp_path):
    genes = jobs.gff3_job(spark, sheet, sizes)
    assert rows(genes.track.clean, "genome", "run", "chrom", "chromStart", "chromEnd", "name", "geneName") == [
        ("gA", "r4", "chr1", 10, 160, "t", "G")
    ]
    assert rows(genes.track.missing) == [("gA", "9", 1)]
    assert genes.bad_models.count() == 0
    out = str(tmp_path / "genes")
    sinks.write_gene_models(genes.track.clean, out)
    assert spark.read.parquet(out).count() == 1
    line = sinks.biggenepred_lines(genes.track.clean).first()[0]
    assert line == "chr1\t10\t160\tt\t0\t+\t160\t160\t0\t2\t50,60,\t0,90,\tG\tnone\tnone\t-1,-1,\tmRNA\tG\tg\tgene"
    again = records.parse_biggenepred(sinks.biggenepred_lines(genes.track.clean))
    assert rows(again) == rows(genes.track.clean, *again.columns)


def test_jobs_without_files(spark, sheet, sizes):
    none = sheet.filter("run = 'r6'")
    assert jobs.bed_job(spark, none, sizes) is None and jobs.gff3_job(spark, none, sizes) is None
    assert jobs.bedgraph_job(spark, none, sizes) is None


def test_interval_sink_is_sorted_and_prunes(spark, tmp_path):
    df = spark.range(2000).select(
        F.concat(F.lit("g"), F.col("id") % 2).alias("genome"),
        F.element_at(F.array(*map(F.lit, ["chr10", "chr2", "Chr1", "chr1"])), (F.col("id") % 4 + 1).cast("int")).alias("chrom"),
        (F.col("id") * 7919 % 1000).alias("start"),
        (F.col("id") * 7919 % 1000 + 5).alias("end"),
        F.array(F.col("id").cast("string")).alias("rest"),
    )
    out = str(tmp_path / "sorted")
    sinks.write_intervals(df, out, partitions=3)
    read = spark.read.parquet(out)
    assert rows(read, *df.columns) == rows(df)
    for genome in ("g0", "g1"):
        spans = []
        for path in glob.glob(f"{out}/genome={genome}/*.parquet"):
            part = [(r["chrom"], r["start"]) for r in spark.read.parquet(path).collect()]
            assert part == sorted(part)
            spans.append((part[0], part[-1]))
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_ranges_follow_the_size_of_the_input(spark, write, tmp_path):
    write("in/a", "x" * 1000)
    write("in/b/c", "x" * 500)
    assert sinks.ranges_for(spark, str(tmp_path / "in"), bytes_per_range=400) == 4


def test_sort_is_by_bytes_then_number(spark):
    from trackspark.operators.intervals import sort_intervals

    data = [("chr10", 1, 2), ("chr2", 30, 31), ("chr2", 4, 9), ("chr2", 4, 5), ("Chr1", 9, 10), ("chr1_gl", 0, 1), ("chr1", 0, 1)]
    df = spark.createDataFrame(data, "chrom string, start bigint, end bigint")
    assert [tuple(r) for r in sort_intervals(df).collect()] == sorted(data)


def test_chrom_sizes_sink(spark, sizes, tmp_path):
    out = str(tmp_path / "sizes")
    sinks.write_chrom_sizes(sizes, out)
    text = spark.read.text(f"{out}/genome=gA")
    assert rows(text, "value") == [("chr1\t1000",), ("chrM\t90",)]
    with pytest.raises(EmptySizesError):
        sinks.write_chrom_sizes(sizes.limit(0), str(tmp_path / "none"))


def test_track_files_of_a_samplesheet(sheet):
    files = jobs.track_files(sheet)
    assert rows(files, "run", "track_type", "path") == [
        ("r1", "bigbed", "r1.bb"), ("r2", "bigbed", "r2.bb"), ("r3", "bigwig", "r3.bw"), ("r4", "bigbed", "r4.bb"),
        ("r5", "bigwig", "/d/r5_x.bw"),
    ]
    catalog = jobs.catalog_job(files, "lab")
    assert rows(catalog.filter("run = 'r2'").select("hub", "params.name")) == [("lab_gB", "lab_gB_r2")]


def test_publish(spark, sheet, tmp_path):
    files = sheet.filter("file_type = 'bigwig'").withColumnRenamed("file_type", "track_type")
    out = str(tmp_path / "hubs")
    sinks.publish(jobs.catalog_job(files), out)
    assert glob.glob(f"{out}/hub=h1/genome=gA/*.parquet")
    assert rows(spark.read.parquet(out), "hub", "genome", "basename") == [("h1", "gA", "r5_x")]


def test_landed_tables_use_the_shared_folder(spark):
    from trackspark.operators.scratch import land, scratch_dir

    landed = land(spark.range(5))
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert landed.inputFiles()[0].split("://")[1].startswith(scratch_dir(spark))
    assert landed.count() == 5


def test_no_record_is_lost_by_the_spelling_of_a_path(spark, tmp_path, monkeypatch):
    """Relative, doubled slashes, a directory, and pattern characters in a name."""
    (tmp_path / "d").mkdir()
    for name in ("a.bed", "y[1].bed", "d/b.bed", "d/c.bed"):
        (tmp_path / name).write_text("chr1\t0\t10\nchr1\tx\t10\nchr9\t0\t1\n")
    names = [f"{tmp_path}//a.bed", f"{tmp_path}/y[1].bed", f"{tmp_path}/d", f"{tmp_path}/d/../a.bed"]
    rows_ = [(f"r{i}", "bed", name, "gA", "", None) for i, name in enumerate(names)]
    sheet = spark.createDataFrame(rows_, "run string, file_type string, path string, genome string, assembly_report string, hub string")
    sizes = spark.createDataFrame([("gA", "chr1", 50)], "genome string, name string, size bigint")
    track = jobs.bed_job(spark, sheet.filter("run != 'r3'"), sizes)
    assert rows(track.clean.groupBy("run").count()) == [("r0", 1), ("r1", 1), ("r2", 2)]
    assert rows(track.rejects.groupBy("run", "reject_reason").count()) == [
        ("r0", "unreadable_position", 1), ("r1", "unreadable_position", 1), ("r2", "unreadable_position", 2)]
    assert rows(track.missing) == [("gA", "chr9", 4)]
    gone = sheet.limit(1).withColumn("path", F.lit(f"{tmp_path}/none.bed"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.bed_job(spark, gone, sizes)
    with pytest.raises(UnmatchedGenomeError):
        jobs.bed_job(spark, sheet, sizes.withColumn("genome", F.lit("other")))
    assert jobs.bed_job(spark, sheet, sizes.withColumn("genome", F.lit("other")), on_unmatched="drop") is None


def test_values_and_sizes_are_checked(spark, tmp_path):
    (tmp_path / "s.sizes").write_text("chr1 1000\nchr2\tabc\n\n")
    sizes = tables.read_chrom_sizes(spark, str(tmp_path / "s.sizes"), "gA")
    assert rows(sizes) == [("gA", "chr1", 1000), ("gA", "chr2", None)]
    signal = spark.createDataFrame(
        [("gA", "chr1", 0, 5, 1.0), ("gA", "chr1", 5, 9, None), ("gA", "chr1", 9, 12, float("nan")), ("gA", "chr2", 0, 5, 1.0)],
        "genome string, chrom string, start bigint, end bigint, value double")
    track = jobs.clean_signal(signal, sizes)
    assert track.clean.count() == 1
    assert rows(track.rejects, "start", "reject_reason") == [
        (0, "unknown_contig_size"), (5, "unreadable_value"), (9, "unreadable_value")]


def test_directory_to_sheet(spark, tmp_path):
    for name in ("S1_x.bw", "two.bed", "notes.md"):
        (tmp_path / name).write_text("x")
    sheet = jobs.directory_sheet(spark, str(tmp_path), "hg38", hub="lab")
    assert rows(sheet, "file_type", "genome", "hub") == [("bed", "hg38", "lab"), ("bigwig", "hg38", "lab")]
    catalog = jobs.catalog_job(jobs.track_files(sheet), ensembl=True)
    assert {r["genome"] for r in catalog.select("genome").collect()} == {"GRCh38"}
