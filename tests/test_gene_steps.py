"""Lines are split once, attributes searched once, and pieces sorted by what tells them apart; what comes out stays the same."""

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trackspark.functions import gff as G
from trackspark.operators import genes
from trackspark.sources import records

LINES = ["##gff", "c\ts\texon\t1\t9\t.\t+\t.\tParent=t,u;Parent=v\r", "c\ts\tmRNA\tx\t9\t1.5\t+\t2\tID=t", "too\tfew", "", None]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("observed", [False, True])
def test_a_line_is_split_once(spark, observed):
    lines = spark.createDataFrame([("g", line) for line in LINES], "genome string, value string")
    seen = Observation() if observed else None
    fields = records.gff3_fields(lines, seen=seen)
    assert optimized(fields).count("split(") == 1
    assert rows(fields) == [
        ("g", "c", "s", "exon", 0, 9, None, "+", None, "Parent=t,u;Parent=v"), ("g", "c", "s", "mRNA", None, 9, 1.5, "+", 2, "ID=t")]
    if observed:
        assert seen.get == {"lines": 6, "comments": 1, "malformed": 2}


def test_parents_are_not_searched_in_a_filter(spark):
    texts = ["Parent=t,u;Parent=v", "Parent=", "ID=x", "Parent=a%2Cb,c", "Parent=,d", " Parent = e ", None]
    gff = spark.createDataFrame([("g", "exon", t) for t in texts], "genome string, type string, attributes string").selectExpr(
        "*", "'c' chrom", "'+' strand", "0L start", "9L end", "0 phase")
    pieces = genes.pieces_of(records.with_attributes(gff), ["genome"])
    assert not any("Filter" in line and "regexp_extract_all" in line for line in optimized(pieces).splitlines())
    assert sorted(r[0] for r in pieces.select("transcript_id").collect()) == ["", " e ", "a,b", "c", "d", "t", "u", "v"]


def test_an_attribute_is_decoded_null_where_empty_or_absent(spark):
    texts = ["Name=a%20b;Name=c", "Name=;Name=c", "Name= ", "XName=a", None, "x;Name = d+e%2 "]
    found = spark.createDataFrame([(t,) for t in texts], "a string").select(G.attribute("a", "Name")).collect()
    assert [r[0] for r in found] == ["a b", None, None, None, None, "d+e%2"]


def test_pieces_are_sorted_by_their_transcript_first(spark):
    data = [("g", "t", "exon", "c", "+", 0, 5, None), ("g", "t", "exon", "c", "+", 0, 5, 1), ("g", "t", "exon", "c", "+", None, 7, None),
            ("g", None, "CDS", "c", "+", 3, 8, 2), ("g", None, "CDS", "c", "+", 3, 8, 0), ("g", None, "CDS", "c", "+", 7, 9, None),
            ("g", "k", "exon", "c", "+", 4, 6, None)]
    pieces = spark.createDataFrame(
        data, "genome string, transcript_id string, kind string, chrom string, strand string, start long, end long, phase int")
    found = genes.transcripts_of(pieces, ("genome",))
    assert "Aggregate [transcript_id" in optimized(found)
    assert rows(found, "transcript_id", "tx_start", "cds_start", "cds_end", "exon_starts", "exon_ends", "exon_frames", "pieces", "reason") == sorted([
        ("t", 0, 7, 7, [None, 0], [7, 5], [-1, -1], 3, "bad_span"),
        (None, 3, 3, 9, [3, 7], [8, 9], [0, 0], 3, "overlapping_exons"),
        ("k", 4, 6, 6, [4], [6], [-1], 1, None)], key=repr)


def test_plain_lists_are_measured_by_their_length(spark):
    from trackspark.operators.lookup import row_bytes

    schema = "a array<long>, b array<string>"
    df = spark.createDataFrame([([1, 2, 3], ["x"]), (None, None)], schema)
    size = row_bytes(df.schema)
    assert [r[0] for r in df.select(size).collect()] == [16 + 24 + 3, 16]
    assert "cast(a" not in optimized(df.select(size.alias("n")))
    assert df.select(F.size("a")).count() == 2
