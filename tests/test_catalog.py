import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackspark.operators import catalog
from trackspark.plans import jobs


@pytest.fixture
def files(spark):
    return spark.createDataFrame(
        [
            ("/d/S1.sorted_macs.bw", "bigwig", "hg38", "my hub"),
            ("/d/S1_orf.final.bb", "BigBed", "hg38", "my hub"),
            ("/d/S2_x.bb", "bigbed", "hg38", ""),
            ("/d/S3.bw", "bigwig", "mm10", None),
        ],
        "path string, track_type string, genome string, hub string",
    )


def metadata(spark):
    return spark.createDataFrame(
        [
            ("S1", "A label that is far too long", "", "", "", "", {"autoScale": "off", "name": "mine"}),
            ("S2", "two", "Two", "9,9,9", "hide", "4", {}),
        ],
        "sample_id string, short_label string, long_label string, color string, visibility string, "
        "priority string, additional_params map<string,string>",
    )


def by_path(df):
    return {r["path"].split("/")[-1]: r for r in df.collect()}


def test_catalog_rows(spark, files):
    got = by_path(jobs.catalog_job(files, "lab", metadata(spark)))
    wig = got["S1.sorted_macs.bw"]
    assert wig["has_metadata"] and wig["composite"] == "composite_all_bigwig"
    assert wig["params"]["name"] == "mine"  # additional parameters override everything
    assert (wig["params"]["autoScale"], wig["params"]["alwaysZero"]) == ("off", "on")
    assert wig["params"]["short_label"] == "A label that is f"
    assert wig["params"]["long_label"] == "my hub - "
    assert wig["params"]["priority"] == "1" and wig["params"]["color"] == "0,0,100"
    bed = got["S1_orf.final.bb"]
    assert bed["annotation_type"] == "orf" and "alwaysZero" not in bed["params"] and "format" not in bed["params"]
    two = got["S2_x.bb"]
    assert (two["hub"], two["params"]["name"]) == ("lab_hg38", "lab_hg38_S2_x")
    assert (two["params"]["color"], two["params"]["visibility"], two["params"]["priority"]) == ("9,9,9", "hide", "4")
    assert two["params"]["long_label"] == "lab_hg38 - Two"
    plain = got["S3.bw"]
    assert not plain["has_metadata"] and plain["short_label"] == "S3" and plain["params"]["visibility"] == "full"


def test_ensembl_mode_has_formats_and_no_composite(spark, files):
    got = by_path(jobs.catalog_job(files, None, ensembl=True))
    assert got["S3.bw"]["composite"] is None and got["S3.bw"]["hub"] == "mm10"
    assert got["S3.bw"]["params"]["format"] == got["S3.bw"]["params"]["type"] == "bigWig"


def test_no_prefix_uses_the_track_type(files):
    tracks = catalog.track_params(catalog.with_track_fields(files))
    assert by_path(tracks)["S3.bw"]["params"]["name"] == "bigwig_S3"


def test_routing_keeps_every_row(spark):
    sheet = spark.createDataFrame(
        [("a", "bed"), ("b", "BED"), ("c", "gff3"), ("d", None), ("e", "bigwig")], "run string, file_type string"
    )
    routed = catalog.route_by_type(sheet)
    assert sorted(routed) == ["bed", "bedgraph", "bigbed", "bigwig", "gff3", "unknown"]
    assert rows(routed["unknown"], "run") == [("b",), ("d",)]
    assert sum(df.count() for df in routed.values()) == 5


def test_hub_groups(files):
    tracks = catalog.with_hub_key(catalog.with_track_fields(files))
    assert rows(catalog.group_hubs(tracks)) == [
        ("hg38", "hg38", "bigbed", "/d/S2_x.bb", 1),
        ("mm10", "mm10", "bigwig", "/d/S3.bw", 1),
        ("my hub", "hg38", "bigbed", "/d/S1_orf.final.bb", 1),
        ("my hub", "hg38", "bigwig", "/d/S1.sorted_macs.bw", 1),
    ]
    by_sample = catalog.group_tracks(tracks)
    assert rows(by_sample) == [
        ("S1", "/d/S1.sorted_macs.bw", 1), ("S1", "/d/S1_orf.final.bb", 1), ("S2", "/d/S2_x.bb", 1), ("S3", "/d/S3.bw", 1)]
    blank = tracks.withColumn("annotation_type", F.when(F.col("annotation_type") == "x", "").otherwise(F.col("annotation_type")))
    assert rows(catalog.group_tracks(blank, "annotation_type"), "annotation_type", "path") == [
        ("default", "/d/S2_x.bb"), ("orf", "/d/S1_orf.final.bb"),
    ]


def test_sizes_are_attached_many_to_one(spark, files):
    sizes = spark.createDataFrame([("hg38", "chr1", 5), ("hg38", "chr2", 7)], "genome string, name string, size bigint")
    with pytest.raises(catalog.UnmatchedGenomeError, match="mm10"):
        catalog.attach_sizes(files, sizes)
    kept = catalog.attach_sizes(files, sizes, on_unmatched="drop")
    assert kept.count() == 3 and {(r["contigs"], r["assembly_size"]) for r in kept.collect()} == {(2, 12)}


def test_duplicate_names_raise(spark, files):
    clash = files.unionByName(files.withColumn("path", F.regexp_replace("path", "S3.bw", "S3.bb")).withColumn("track_type", F.lit("bigbed")))
    tracks = jobs.catalog_job(clash.filter("path like '%S3%'"))
    with pytest.raises(catalog.DuplicateTrackError, match="mm10/mm10/mm10_S3"):
        catalog.check_unique_names(tracks)
    catalog.check_unique_names(jobs.catalog_job(files))


def test_multi_assembly_table(spark, files):
    out = jobs.aggregate_job(files, files.drop("hub"))
    assert [r["path"] for r in out.collect()] == [
        "/d/S1.sorted_macs.bw", "/d/S1_orf.final.bb", "/d/S2_x.bb", "/d/S3.bw",
    ]
