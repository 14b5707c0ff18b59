import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackspark.operators import sizes
from trackspark.sources import tables

TAB_HEADER = "# Sequence-Name\tSequence-Role\tGenBank-Accn\tRefSeq-Accn\tSequence-Length\tUCSC-style-name"


def report(spark, write, text, name="r.txt"):
    path = write(name, text)
    return tables.read_assembly_report(spark, path).withColumn("genome", F.lit("g")).drop("path")


def seqids(spark, *names):
    return spark.createDataFrame([("g", n) for n in names], "genome string, seqid string")


BODY = (
    "1\tx\tCM1\tNC_1\t100\tchr1\n"
    "2\tx\tCM2\tna\t200\tna\n"
    "MT\tx\tCM3\tNC_3\t30\tchrM\n"
    "1\tx\tCM4\tNC_4\t999\tchr1\n"
    "bad\tx\tCM5\tNC_5\tten\tchr9\n"
    "short\n"
)


@pytest.mark.parametrize(
    "names, force, chosen",
    [
        ([], True, "ucsc-style-name"),
        ([], False, "sequence-name"),
        (["chr1", "chrM"], True, "ucsc-style-name"),
        (["1", "2", "MT"], True, "sequence-name"),
        (["NC_1", "NC_3"], True, "refseq-accn"),
        (["CM2"], True, "genbank-accn"),
        (["zzz"], True, "ucsc-style-name"),
        (["zzz"], False, "sequence-name"),
        (["chr1", "1"], True, "ucsc-style-name"),
        (["chr1", "1"], False, "sequence-name"),
        (["NC_1", "CM1"], False, "refseq-accn"),
    ],
)
def test_name_column(spark, write, names, force, chosen):
    rep = report(spark, write, TAB_HEADER + "\n" + BODY)
    assert rows(sizes.choose_name_column(rep, seqids(spark, *names), force)) == [("g", chosen)]


def test_sizes_by_ucsc_name_fall_back_to_the_sequence_name(spark, write):
    rep = report(spark, write, "# comment\r\n" + TAB_HEADER + "\r\n" + BODY.replace("\n", "\r\n"))
    got = sizes.chrom_sizes_from_reports(rep, seqids(spark))
    assert rows(got) == [("g", "2", 200), ("g", "chr1", 100), ("g", "chrM", 30)]


def test_plain_names_get_chr_when_forced(spark, write):
    rep = report(spark, write, TAB_HEADER + "\n" + BODY)
    ids = seqids(spark, "1", "2", "MT")
    assert rows(sizes.chrom_sizes_from_reports(rep, ids), "name", "size") == [("chr1", 100), ("chr2", 200), ("chrM", 30)]
    plain = sizes.chrom_sizes_from_reports(rep, ids, force_ucsc=False)
    assert rows(plain, "name", "size") == [("1", 100), ("2", 200), ("MT", 30)]


def test_the_last_header_counts_and_may_be_split_by_blanks(spark, write):
    text = TAB_HEADER + "\n# Sequence_Name no\n#Sequence-Name  Sequence-Length\n" + "A\t5\nB\t6\n"
    rep = report(spark, write, text)
    assert rows(sizes.chrom_sizes_from_reports(rep, seqids(spark)), "name", "size") == [("A", 5), ("B", 6)]


def test_reports_without_a_header_go_by_position(spark, write):
    rep = report(spark, write, "7\tx\t70\tend\nctg\ty\t80\nX\t90\nna\t5\n")
    got = sizes.chrom_sizes_from_reports(rep, seqids(spark))
    # the field before the last holds the length if it is digits, else the last does
    assert rows(got, "name", "size") == [("chr7", 70), ("chrX", 90), ("ctg", 80)]
    assert sizes.choose_name_column(rep, seqids(spark)).count() == 0


def test_header_without_candidates(spark, write):
    rep = report(spark, write, "# The Sequence-Name and Sequence-Length\tlist\nQ\t12\n")
    assert rows(sizes.chrom_sizes_from_reports(rep, seqids(spark)), "name", "size") == [("Q", 12)]


def test_sources(spark):
    rows_ = spark.createDataFrame(
        [("a", "ucsc", "u"), ("a", "report", "r"), ("b", "fasta", "f"), ("b", "ucsc", "u2"), ("c", "other", "o")],
        "genome string, source string, path string",
    )
    assert rows(sizes.pick_sizes_source(rows_)) == [("a", "report", "r"), ("b", "ucsc", "u2"), ("c", "other", "o")]
    genomes = spark.createDataFrame(
        [("hg38", ""), ("GCA_1", ""), ("GCF_2", "/r"), ("mm10", None), ("hg38", "")],
        "genome string, assembly_report string",
    )
    with_report, by_name = sizes.split_size_sources(genomes)
    assert rows(with_report) == [("GCF_2", "/r")]
    assert rows(by_name) == [("hg38",), ("mm10",)]
