"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as driver
from checks.compare import compare
from checks.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, name):
    frames = []

    def run(session, sf_dir):
        frames.append(QUERIES[name](session, sf_dir))
        return frames[-1]

    ok, message = compare(spark, SF_DIR, name, run, ORACLES.get(name))
    assert ok, message
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    for banned in ("PythonUDF", "EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= driver.queries().items()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_published_anchors(spark):
    """Contig and bounds counts measured independently on these tables."""
    from checks import inputs
    from trackspark.operators.contigs import harmonise_contigs

    rows = inputs.intervals(spark, SF_DIR).selectExpr("*", "chrom as was")
    got = harmonise_contigs(rows, inputs.sizes(spark, SF_DIR)).selectExpr(
        "count(*) n", "count_if(known and chrom = was) exact", "count_if(known and chrom != was) remapped",
        "count_if(not known) missing", "count_if(known and end > contig_size) outside",
    ).first()
    assert tuple(got) == (6000, 3042, 2200, 758, 505)
