"""Region reads, counts of one write, joint listings."""

import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trackspark.plans import jobs
from trackspark.sinks import regions
from trackspark.sinks.tracks import write_intervals
from trackspark.sources import records
from trackspark.sources.text import plain_path, resolve_files

from conftest import rows


@pytest.fixture
def table(spark, tmp_path):
    """4,000 records in 8 files on one contig, one of them 300,000 long near the beginning; another contig; a numeric genome."""
    df = spark.range(4_000).select(
        F.lit("38").alias("genome"), F.lit("chr1").alias("chrom"), (F.col("id") * 100).alias("start"),
        F.when(F.col("id") == 7, 300_700).otherwise(F.col("id") * 100 + 50).alias("end"), F.col("id").alias("value"))
    other = spark.createDataFrame([("38", "chr2", 10, 10, 1), ("hg", "chr1", 5, 9, 2)], df.schema)
    path = str(tmp_path / "t [1]")
    write_intervals(df.unionByName(other), path, partitions=8)
    regions.write_index(spark, path, block_rows=200)
    return path


def test_a_region_opens_only_the_files_that_reach_into_it(spark, table):
    every = len(spark.read.parquet(table.replace("[", r"\[").replace("]", r"\]")).inputFiles())
    found = regions.read_region(spark, table, "38", "chr1", 250_000, 250_200)
    assert rows(found, "value") == [(2500,), (2501,), (7,)]
    assert 1 <= len(found.inputFiles()) <= 2 < every
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(start,250200)" in plan and ">= 250000)" in plan
    assert regions.read_region(spark, table, "38", "chr9", 0, 10).count() == 0
    assert rows(regions.read_region(spark, table, "38", "chr2", 10, 10), "value") == [(1,)]  # empty record and region
    assert rows(regions.read_region(spark, table, "hg", "chr1", 8, 20), "genome", "value") == [("hg", 2)]


def test_regions_match_a_plain_comparison(spark, table):
    wanted = [("38", "chr1", s, s + w, i) for i, (s, w) in enumerate([(0, 1), (399_900, 500), (131_000, 200_000), (55, 1), (40, 20)])]
    found = regions.read_regions(spark, table, spark.createDataFrame(wanted, "genome string, chrom string, start long, end long, n int"))
    spans = [(i * 100, 300_700 if i == 7 else i * 100 + 50, i) for i in range(4_000)]
    assert rows(found, "region_n", "value") == sorted(
        ((n, v) for _, _, a, b, n in wanted for s, e, v in spans if s < b and e > a), key=repr)


def test_counts_come_from_the_write(spark, write, tmp_path):
    (tmp_path / "a.bg.gz").write_bytes(gzip.compress(b"track x\n#c\nchr1\t1\t5\t2\nchr1\t9\t99\t2\nchr7\t1\t2\t3\nchr1\t3\t3\t1\n"))
    sheet = spark.createDataFrame([("r", "bedgraph", str(tmp_path / "a.bg.gz"), "g")], "run string, file_type string, path string, genome string")
    sizes = spark.createDataFrame([("g", "chr1", 50)], "genome string, name string, size long")
    track = jobs.bedgraph_job(spark, sheet, sizes)
    assert track.counts == {"lines": 6, "headers": 2, "input": 4, "clean": 1, "missing": 1, "rejects": 2}
    assert (track.clean.count(), track.rejects.count(), rows(track.missing)) == (1, 2, [("g", "chr7", 1)])


def test_gzipped_text_is_parsed_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.bed.gz").write_bytes(gzip.compress(b"".join(b"c\t%d\t%d\n" % (i, i + 1) for i in range(500))))
    found = records.read_bed(spark, str(tmp_path / "a.bed.gz"))
    assert found.select(F.spark_partition_id()).distinct().count() > 1 and found.count() == 500


def test_a_stray_file_ends_the_job_whatever_is_selected(spark):
    lines = spark.createDataFrame([("/a", "x"), ("/b", "y")], "path string, value string")
    files = spark.createDataFrame([("/a", "g")], "path string, genome string")
    with pytest.raises(PySparkException, match="no samplesheet row names the file /b"):
        jobs.attach_files(lines, files, ["genome"]).select("genome").collect()


def test_paths_are_listed_together(spark, tmp_path):
    """2,000 files, a folder and odd spellings: as few Spark jobs as for two files; missing files raise, empty ones count."""
    for i in range(2_000):
        (tmp_path / f"f{i}.bed").write_text("x")
    (tmp_path / "d" / "e").mkdir(parents=True)
    for name in ("d/1.bed", "d/2 [x].bed"):
        (tmp_path / name).write_text("x")
    (tmp_path / "empty.bed").write_text("")

    def jobs_of(paths):
        group = f"resolve {len(paths)}"
        spark.sparkContext.setJobGroup(group, group)
        found = resolve_files(spark, spark.createDataFrame([(p,) for p in paths], "path string")).collect()
        return sorted(r.path for r in found), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    base = str(tmp_path)
    few, n_few = jobs_of([f"{base}/f0.bed", f"{base}/f1.bed"])
    many, n_many = jobs_of([f"{base}/f{i}.bed" for i in range(2_000)])
    assert len(few) == 2 and len(many) == 2_000 and n_many <= n_few + 1
    odd, _ = jobs_of([f"{base}//d/", f"{base}/d/../f3.bed", f"file:{base}/f4.bed", f"{base}/empty.bed"])
    assert odd == sorted([f"{base}/d/1.bed", f"{base}/d/2 [x].bed", f"{base}/f3.bed", f"{base}/f4.bed", f"{base}/empty.bed"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no files"):
        jobs_of([f"{base}/none.bed"])
    assert plain_path("s3a://b//x/../y") == "s3a://b/y" and plain_path("file:///a/./b") == "/a/b"
