import gzip

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trackspark.sources import fasta, logs, records, tables, text


def test_bed_fields_split_on_runs_of_blanks(spark, write):
    path = write(
        "a b/x.bed",
        "chr1\t0\t10\tone\t5\t+\t0\t10\t0,0,0\t2\t3,4,\t0,6\n"
        "track name=x\n"
        "  1 \t 5  7\ttwo words\t9\t-  \n"
        "\n"
        "chr2\t7\n"
        "M\t1.5\t3\n",
    )
    df = records.read_bed(spark, path)
    assert rows(df, "chrom", "start", "end") == sorted(
        [("chr1", 0, 10), ("track", None, None), ("1", 5, 7), ("", None, None), ("chr2", 7, None), ("M", None, 3)],
        key=repr,
    )
    assert {r["path"] for r in df.collect()} == {path}
    typed = records.typed_bed(df)
    first = typed.filter("chrom = 'chr1'").first()
    assert (first["score"], first["block_sizes"], first["block_starts"]) == (5, [3, 4], [0, 6])
    shifted = typed.filter("chrom = '1'").first()
    assert (shifted["name"], shifted["score"], shifted["strand"], shifted["rest"]) == (
        "two", None, "9", ["two", "words", "9", "-"],
    )
    by_tab = records.typed_bed(records.read_bed(spark, path, sep="tab")).filter("chrom = 'chr1'").first()
    assert by_tab["name"] == "one"


def test_bedgraph_headers_go_by_prefix(spark, write):
    path = write("x.bedgraph", "track type=bedGraph\nbrowser x\n#c\ntrack1\t0\t5\t1\nchr1\t0\t5\t-2.5\n chr1 5 9 1e3\n")
    assert rows(records.read_bedgraph(spark, path), "chrom", "start", "end", "value") == [
        ("chr1", 0, 5, -2.5), ("chr1", 5, 9, 1000.0),
    ]


GFF = """##gff-version 3
chr1\tsrc\tgene\t101\t900\t.\t+\t.\tID=g1;Name=Gene%20One;biotype=coding
chr1\tsrc\tmRNA\t101\t900\t.\t+\t.\tID=t1;Parent=g1;AdditionalSources=a,b;Name=T+1;AdditionalSources=c
chr1\tsrc\texon\t101\t200\t.\t+\t.\tParent=t1,t2
chr1\tsrc\texon\t301\t400\t5.5\t+\t.\tParent=t1
chr1\tsrc\tCDS\t151\t200\t.\t+\t0\tParent=t1
chr1\tsrc\tCDS\t301\t350\t.\t+\t2\tParent=t1
chr1\tsrc\tmRNA\t101\t900\t.\t+\t.\tID=t2;Parent=g1
chr1\tsrc\texon\t501\t600\t.\t+\t.\tParent=lost
chr1\tsrc\tgene\t1000\t2000\t.\t-\t.\tAdditionalSources=z;ID=g2;Note=first;Note=second;Name=bad%zz
chr1\tsrc\texon\t1001\t1100\t.\t-\t.\tParent=g2
chr1\tsrc\texon\t1101\t1200\t.\t-\t.\tParent=g2
chr1\tsrc\tmRNA\t1000\t2000\t.\t-\t.\tID=t3;Parent=g2
chr1\tsrc\tCDS\t1001\t1010\t.\t-\t1\tParent=t3
##FASTA
>chr1
ACGT
"""


@pytest.fixture(params=["plain", "gzip"])
def gff(spark, write, request):
    path = write("a.gff3", GFF)
    if request.param == "gzip":
        zipped = path.replace("a.gff3", "z.gff3.gz")
        with gzip.open(zipped, "wt") as out:
            out.write(GFF)
        path = zipped
    return records.read_gff3(spark, path, partitions=3).withColumn("genome", F.lit("g"))


def test_gff3_features(gff):
    assert gff.count() == 13
    by_id = {r["id"]: r for r in gff.filter("id is not null").collect()}
    assert (by_id["g1"]["start"], by_id["g1"]["end"], by_id["g1"]["name"]) == (100, 900, "Gene One")
    assert by_id["t1"]["name"] == "T+1"
    assert by_id["t1"]["attributes"].endswith("Name=T+1;AdditionalSources=c")
    assert by_id["g2"]["attributes"].startswith("AdditionalSources=z")
    assert by_id["g2"]["name"] == "bad%zz"
    shared = gff.filter("type = 'exon' and start = 100").first()
    assert shared["parents"] == ["t1", "t2"]
    assert gff.filter("score = 5.5").count() == 1


def test_gene_models(gff):
    from trackspark.operators import genes

    models, rejects = genes.gene_models(gff)
    by_id = {r["transcript_id"]: r for r in models.collect()}
    assert sorted(by_id) == ["g2", "t1", "t2", "t3"]
    t1 = by_id["t1"]
    assert (t1["name"], t1["name2"], t1["gene_type"]) == ("T+1", "Gene One", "coding")
    assert (t1["exon_starts"], t1["exon_ends"], t1["exon_frames"]) == ([100, 300], [200, 400], [0, 1])
    assert (t1["tx_start"], t1["tx_end"], t1["cds_start"], t1["cds_end"]) == (100, 400, 150, 350)
    assert (by_id["t2"]["cds_start"], by_id["t2"]["cds_end"], by_id["t2"]["exon_frames"]) == (200, 200, [-1])
    assert (by_id["g2"]["name"], by_id["g2"]["gene_id"], by_id["g2"]["exon_starts"]) == ("bad%zz", "g2", [1000, 1100])
    assert (by_id["t3"]["exon_starts"], by_id["t3"]["exon_frames"], by_id["t3"]["name"]) == ([1000], [2], "t3")
    assert rows(rejects, "transcript_id", "reason") == [("lost", "missing_parent")]
    row = genes.to_biggenepred(models).filter("name = 'T+1'").first()
    assert (row["blockCount"], row["blockSizes"], row["chromStarts"]) == (2, [100, 100], [0, 200])
    assert (row["cdsStartStat"], row["geneName2"], row["type"]) == ("cmpl", "g1", "mRNA")


def test_bad_models_are_rejected_with_a_reason(spark):
    from trackspark.operators import genes

    def line(chrom, kind, start, end, strand, attributes):
        return (f"{chrom}\ts\t{kind}\t{start}\t{end}\t.\t{strand}\t0\t{attributes}",)

    data = [line("chr1", "mRNA", 1, 99, "+", f"ID=t{i}") for i in range(6)]
    data += [line("chr1", "exon", 1, 9, "+", "Parent=t0"), line("chr2", "exon", 11, 19, "+", "Parent=t0")]
    data += [line("chr1", "exon", 1, 9, "+", "Parent=t1"), line("chr1", "exon", 11, 19, "-", "Parent=t1")]
    data += [line("chr1", "exon", 9, 1, "+", "Parent=t2")]
    data += [line("chr1", "exon", 1, 9, "+", "Parent=t3"), line("chr1", "exon", 9, 19, "+", "Parent=t3")]
    data += [line("chr1", "exon", 1, 9, "+", "Parent=t4"), line("chr1", "CDS", 5, 19, "+", "Parent=t4")]
    data += [line("chr1", "exon", 1, 9, "+", "Parent=t5")] * 3  # copies are one exon
    gff = records.parse_gff3(spark.createDataFrame(data, "value string").selectExpr("'g' as genome", "value"))
    models, rejects = genes.gene_models(gff, keys=("genome",))
    assert rows(models, "transcript_id", "exon_starts") == [("t5", [0])]
    assert rows(rejects, "transcript_id", "reason") == [
        ("t0", "mixed_contig"), ("t1", "mixed_strand"), ("t2", "bad_span"), ("t3", "overlapping_exons"),
        ("t4", "cds_outside_exons"),
    ]


def test_fasta_lengths_over_many_splits(spark, write):
    text_, want = "", []
    for i in range(300):
        lines = [] if i % 7 == 0 else ["ACGT" * (i % 5 + 1)] * (i % 11)
        want.append((f"s{i}", sum(map(len, lines))))
        text_ += f">s{i} a > b\n" + "".join(line + "\n" for line in lines)
    path = write("g.fa", "stray\n" + text_)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        for chunk in (4, 8192):
            lines = text.read_ordered_lines(spark, path)
            assert lines.select("block").distinct().count() > 5
            got = fasta.sequence_lengths(lines, chunk_lines=chunk)
            assert rows(got, "name", "size") == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows(fasta.fasta_chrom_sizes(spark, path, "g").limit(1), "genome") == [("g",)]


def test_fasta_file_without_final_newline_and_with_carriage_returns(spark, write):
    path = write("w.fa", ">a one\r\nACGT\r\nAC\r\n>b\r\n>c\r\nA")
    assert rows(fasta.fasta_chrom_sizes(spark, path), "name", "size") == [("a", 6), ("b", 0), ("c", 1)]


def test_samplesheet_columns(spark, write):
    path = write("s.csv", "Run,FileType,Path,Genome\nr1,bed,/d/x.bed,hg38\n")
    assert rows(tables.read_samplesheet(spark, path)) == [("r1", "bed", "/d/x.bed", "hg38", "", None)]
    full = write("f.csv", "Run,FileType,Path,Genome,AssemblyReport,Hub\nr1,bed,/d/x.bed,g,,h\nr2,bed,/d/y.bed,g,/r,\n")
    assert rows(tables.read_samplesheet(spark, full), "run", "assembly_report", "hub") == [
        ("r1", "", "h"), ("r2", "/r", None),
    ]
    with pytest.raises(ValueError, match="Genome"):
        tables.read_samplesheet(spark, write("bad.csv", "Run,FileType,Path\nr,bed,/x\n"))


def test_sample_metadata(spark, write):
    path = write(
        "m.csv",
        'sample_id,short_label,color,additional_params\n'
        'a,first,"1,2,3","{""k"":""v"",""n"":2}"\n'
        ' ,blank,,\n'
        'b,,,{bad\n'
        'a,last,"4,5,6",\n',
    )
    got = {r["sample_id"]: r for r in tables.read_sample_metadata(spark, path).collect()}
    assert sorted(got) == ["a", "b"]
    assert (got["a"]["short_label"], got["a"]["color"], got["a"]["additional_params"]) == ("last", "4,5,6", {})
    assert (got["b"]["short_label"], got["b"]["long_label"], got["b"]["priority"]) == ("", "b", "1")
    assert got["b"]["additional_params"] == {}
    with pytest.raises(ValueError, match="sample_id"):
        tables.read_sample_metadata(spark, write("n.csv", "id\n1\n"))


def test_listing_and_logs(spark, write, tmp_path, caplog):
    for name in ("d/b.bed", "d/sub/a.bed", "d/c.txt"):
        write(name, "x")
    found = tables.list_track_files(spark, str(tmp_path / "d"), glob="*.bed")
    assert [r["path"] for r in found.collect()] == [str(tmp_path / "d/b.bed"), str(tmp_path / "d/sub/a.bed")]
    assert tables.list_track_files(spark, str(tmp_path / "none")).count() == 0
    assert "no track files" in caplog.text
    paths = [write("l1.log", "a\nb\n"), write("l2.log", ""), write("l3.log", "c")]
    assert rows(logs.summarise_logs(spark, paths)) == [(3, 3)]


def test_chrom_sizes(spark, write):
    path = write("c.sizes", "chr1\t100\nchr2\t50\textra\n")
    assert rows(tables.read_chrom_sizes(spark, path, "g")) == [("g", "chr1", 100), ("g", "chr2", 50)]


def test_unreadable_parameters_are_counted_and_listed(spark, write):
    path = write("meta.csv", 'sample_id,additional_params\ns1,"{""a"":1,""a"":2}"\ns2,{oops\n ,{oops\ns2,\ns3,[1]\n')
    seen = Observation()
    got = tables.read_sample_metadata(spark, path, seen)
    assert {r.sample_id: r.additional_params for r in got.collect()} == {"s1": {"a": "2"}, "s2": {}, "s3": {}}
    assert seen.get == {"rows": 4, "unreadable_params": 2}
    warned = tables.metadata_warnings(tables.read_metadata_sheet(spark, path))
    assert sorted((r.sample_id, r.additional_params) for r in warned.collect()) == [("s2", "{oops"), ("s3", "[1]")]
    assert tables.metadata_warnings(spark.sql("select 's' as sample_id, 1 as row_order")).collect() == []
