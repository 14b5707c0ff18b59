import os
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackspark.functions import gff, names, values


def column(spark, items, build):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


def test_chrize(spark):
    got = column(spark, ["1", "22", "X", "Y", "M", "MT", "chr1", "1a", "", "x"], names.chrize)
    assert got == ["chr1", "chr22", "chrX", "chrY", "chrM", "chrM", "chr1", "1a", "", "x"]


def test_header_key(spark):
    assert column(spark, [" Sequence-Name ", "UCSC_style name"], names.header_key) == ["sequence-name", "ucsc-style-name"]


FILES = ["a.bw", "a.b.c", ".bashrc", "...x", "..a.b", "a..b", "x.", "noext", "", ".a.b", "a\nb.c"]


def test_extension_matches_the_standard_library(spark):
    assert column(spark, FILES, names.without_extension) == [os.path.splitext(f)[0] for f in FILES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab./-_ ", max_size=12), min_size=40, max_size=40))
def test_path_parts_match_the_standard_library(spark, items):
    base = [os.path.basename(x) for x in items]
    assert column(spark, items, names.basename) == base
    assert column(spark, base, names.without_extension) == [os.path.splitext(x)[0] for x in base]
    want = [re.sub("[^a-zA-Z0-9_]", "", x.replace(".", "_").replace("-", "_")) for x in items]
    assert column(spark, items, names.sanitise) == want


@pytest.mark.parametrize(
    "raw, label",
    [
        ("SRR1.multi_no_junction.forward", "SRR1 multi no junction forward"),
        ("s_Sorted.FINAL_x", "s x"),
        ("a.so.sortedrted", "a sorted"),
        ("a._sortedfinal", "a final"),
        ("a_.sortedfinal", "a"),
        ("sorted", "sorted"),
        ("a-b..c__d", "a-b c d"),
        ("x.dedup.duplicates", "x"),
    ],
)
def test_readable_label(spark, raw, label):
    assert column(spark, [raw], names.readable_label) == [label]


def test_pattern_groups(spark):
    pattern = r"^(x|y)(?P<sample_id>S\d+)_(?P<other>\w)(?P=other)"
    files = ["xS12_aa.bw", "xS12_ab.bw"]
    got = column(spark, files, lambda c: names.sample_id(c, names.sanitise(c), pattern))
    assert got == ["S12", "xS12"]
    assert column(spark, ["p_q_r", "p"], lambda c: names.annotation_type(c, c)) == ["q", "default"]
    assert column(spark, ["p_q"], lambda c: names.annotation_type(c, c, "(?P<sample_id>p)")) == ["q"]


def test_file_types_and_runs(spark):
    files = ["a.bed", "a.bg", "b.x.bb", "bw", "a.BED", "a.gff3", "a.txt", "a.bigwig"]
    assert column(spark, files, names.file_type) == [
        "bed", "bedgraph", "bigbed", "bigwig", "unknown", "gff3", "unknown", "bigwig",
    ]
    assert column(spark, ["ncORFs_a.b.bed", "xncORFs_a", "ncORFs_.z"], names.run_name) == ["a.b", "xncORFs_a", ""]


def test_ensembl_genome(spark):
    got = column(spark, ["hg38", "hg19.p1", "hg18", "mm-hg38"], names.ensembl_genome)
    assert got == ["GRCh38", "GRCh37.p1", "hg18", "mm-hg38"]


def test_labels_are_cut(spark):
    assert column(spark, ["a" * 20], names.short_label) == ["a" * 17]
    assert column(spark, ["b" * 90], lambda c: names.long_label(c, F.lit("hub"))) == ["hub - " + "b" * 70]
    assert column(spark, ["n"], lambda c: names.track_name(c, F.lit("bigwig"))) == ["bigwig_n"]
    assert column(spark, ["n"], lambda c: names.track_name(c, F.lit("bigwig"), F.lit("my hub-1"))) == ["my_hub_1_n"]


def test_numbers_and_lists(spark):
    assert column(spark, ["7", " 8 ", "1.5", "x", ""], values.number) == [7, 8, None, None, None]
    assert column(spark, ["1,2,", "3", "", "4,x"], values.number_list) == [[1, 2], [3], [], [4, None]]
    assert column(spark, ["1,2,"], lambda c: values.joined_list(values.number_list(c))) == ["1,2,"]


def test_maps(spark):
    got = column(spark, ['{"a":"x","b":2}', "{bad", None, "[1]", ""], values.json_map)
    assert got == [{"a": "x", "b": "2"}, {}, {}, {}, {}]
    base = F.create_map(F.lit("a"), F.lit("old"), F.lit("c"), F.lit("kept"))
    assert column(spark, ['{"a":"x"}'], lambda c: values.merge_maps(base, values.json_map(c))) == [
        {"c": "kept", "a": "x"}
    ]
    # The last of repeated keys counts, in a session that leaves Spark's setting for them alone.
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == "EXCEPTION"
    repeated = ['{"a":1,"b":2,"a":3}', '{"a":1,"a":null}', '{"c":[1],"c":{"d":1,"d":2},"a":"z"}']
    assert column(spark, repeated, values.json_map) == [{"a": "3", "b": "2"}, {"a": None}, {"c": '{"d":1,"d":2}', "a": "z"}]
    assert column(spark, repeated, lambda c: values.merge_maps(base, values.json_map(c)))[0] == {"a": "3", "b": "2", "c": "kept"}
    assert column(spark, ['{"a":1}', "{bad", "", " ", None, "[1]"], values.unreadable_json) == [False, True, False, False, None, True]


def test_attributes(spark):
    text = ["ID=a;Parent=p%2C1,p2;Note=n1;Note=n2;Name=", "XID=b; ID = c", "", "Parent=q;Parent=r"]
    assert column(spark, text, lambda c: gff.attribute(c, "ID")) == ["a", "c", None, None]
    assert column(spark, text, lambda c: gff.attribute(c, "Name")) == [None] * 4
    assert column(spark, text, lambda c: gff.attribute_list(c, "Parent")) == [["p,1", "p2"], [], [], ["q", "r"]]
    pairs = column(spark, text, gff.attribute_pairs)
    assert [(p["k"], p["v"]) for p in pairs[0]][2:4] == [("Note", "n1"), ("Note", "n2")]
    assert column(spark, ["a+b%20c", "50%", "%zz", "é%C3%A9"], gff.percent_decode) == ["a+b c", "50%", "%zz", "éé"]


def test_strip_attribute(spark):
    def strip(c):
        return gff.without_attribute(c, "AdditionalSources")

    got = column(spark, ["ID=1;AdditionalSources=a;X=2;AdditionalSources=b", "AdditionalSources=a;ID=1", "ID=1;AdditionalSources="], strip)
    assert got == ["ID=1;X=2;AdditionalSources=b", "AdditionalSources=a;ID=1", "ID=1"]
