"""Feature chains of any depth, cycles, and byte ranges."""

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackspark.operators.genes import gene_models, top_ancestors
from trackspark.operators.ranges import byte_cells, clustered_by_bytes, ranges_of
from trackspark.sources.records import parse_gff3


def _walk(parents, node):
    seen, depth = {node}, 0
    while parents.get(node) is not None:
        node, depth = parents[node], depth + 1
        if node in seen:
            return None, None, True
        seen.add(node)
    return node, depth, False


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 14)), min_size=1))
def test_ancestors_match_a_walk(spark, links):
    frame = spark.createDataFrame([("g", str(k), None if v is None else str(v)) for k, v in links.items()], "genome string, id string, parent string")
    found = {r.id: (r.top, r.depth, r.cycle) for r in top_ancestors(frame, ["genome"]).collect()}
    text = {str(k): None if v is None else str(v) for k, v in links.items()}
    assert found == {k: _walk(text, k) for k in text}


def test_models_below_deep_chains_and_cycles(spark):
    line = "c\t.\t{}\t1\t10\t.\t+\t.\t{}".format
    text = [line("region", "ID=top;Name=Top"), line("gene", "ID=g;Parent=top"), line("mRNA", "ID=m;Parent=g"), line("exon", "Parent=m"),
            line("gene", "ID=a;Parent=b"), line("gene", "ID=b;Parent=a"), line("mRNA", "ID=c;Parent=a"), line("exon", "Parent=c"),
            line("mRNA", "ID=self;Parent=self"), line("exon", "Parent=self"), line("mRNA", "ID=far;Parent=gone"), line("exon", "Parent=far")]
    gff = parse_gff3(spark.createDataFrame([("g", t) for t in text], "genome string, value string"))
    models, rejects = gene_models(gff, ["genome"])
    assert rows(models, "transcript_id", "gene_id", "name2") == [("far", "gone", "gone"), ("m", "top", "Top")]
    assert rows(rejects, "transcript_id", "reason") == [("c", "parent_cycle"), ("self", "parent_cycle")]


def test_ranges_follow_bytes(spark):
    df = spark.range(3_000).select(
        F.lit("g").alias("genome"), F.lit("c").alias("chrom"), F.when(F.col("id") < 1_000, 5).otherwise(F.col("id") * 10).cast("long").alias("start"),
        (F.col("id") * 10 + 1).alias("end"), F.when(F.col("id") % 2 == 0, "x" * 100).otherwise("x").alias("name"))
    cells = byte_cells(df, ["genome", "chrom"], width=100)
    placed = ranges_of(cells, ["genome", "chrom"], 20_000).collect()
    assert [r.tile for r in placed if r.heavy] == [0]
    light = sorted((r.tile, r.range) for r in placed if not r.heavy)
    assert [r for _, r in light] == sorted(r for _, r in light) and light[0][1] == 1
    out = clustered_by_bytes(df, per_range=20_000, width=100)
    sizes = [len(p) for p in out.select("start").rdd.glom().collect()]
    assert sum(sizes) == 3_000 and max(sizes) < 600 and out.columns == df.columns
    assert clustered_by_bytes(df.limit(0)).count() == 0
