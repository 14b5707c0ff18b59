"""The physical plans we rely on."""

import os

import pytest

from checks import inputs, interval_queries
from trackspark.operators import intervals, signal

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


def plan_of(df, run=False):
    if run:
        df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_four_columns_and_joins_by_broadcast(spark):
    plan = plan_of(interval_queries.clean_intervals_by_contig(spark, SF_DIR))
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    scan = [line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(scan) == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in scan[0]


def test_coverage_shuffles_its_events_once(spark):
    clean = interval_queries._clean(spark, SF_DIR)
    depth = intervals.coverage_depth(clean, keys=("genome", "chrom"))
    depth.collect()
    assert "ReusedExchange" in plan_of(depth)


def test_summary_levels_share_the_finest_one(spark):
    rows = inputs.intervals(spark, SF_DIR)
    levels = signal.summarise_signal(rows, [1000, 4000, 16000], keys=("genome", "chrom"))
    levels.collect()
    plan = plan_of(levels)
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_region_filters_reach_the_written_table(spark, tmp_path):
    from trackspark.sinks.tracks import write_intervals

    out = str(tmp_path / "intervals")
    write_intervals(inputs.intervals(spark, SF_DIR), out)
    region = spark.read.parquet(out).filter("genome = 'asm' and chrom = 'chr1' and start < 500 and `end` > 100")
    plan = plan_of(region.select("start", "end", "value"))
    assert "PartitionFilters: [isnotnull(genome" in plan
    for pushed in ("EqualTo(chrom,chr1)", "LessThan(start,500)"):
        assert pushed in plan
