"""What a task holds does not grow with the input."""

import glob

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from checks.sink_queries import _placed, directory_job
from trackspark.operators import intervals
from trackspark.operators.scratch import land, scratch_dir


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_positions_are_counted_by_partition(spark):
    rows = spark.range(1000, numPartitions=8).select((F.lit(999) - F.col("id")).alias("id"))
    placed = _placed(rows)
    assert "row_number" not in plan_of(placed)  # which would bring all rows to one task
    assert [tuple(r) for r in placed.orderBy("position").collect()] == [(999 - n, n + 1) for n in range(1000)]
    assert dict(placed.dtypes)["position"] == "int"


def test_positions_pass_over_empty_partitions(spark):
    rows = spark.range(100, numPartitions=8).filter("id between 30 and 34 or id = 99")
    assert [tuple(r) for r in _placed(rows).orderBy("position").collect()] == [(30, 1), (31, 2), (32, 3), (33, 4), (34, 5), (99, 6)]
    assert _placed(rows.filter("id < 0")).count() == 0


def test_files_of_a_folder_come_from_several_tasks(spark, tmp_path):
    items = spark.range(400, numPartitions=4).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 28).alias("l_partkey"), F.lit(1).alias("l_linenumber"),
        F.lit(5.0).alias("l_quantity"), (F.col("id") * 100.0).alias("l_extendedprice"))
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(25).select(F.col("id").alias("n_nationkey")).write.parquet(f"{tmp_path}/nation.parquet")
    before = set(glob.glob(f"{scratch_dir(spark)}/*/query-*"))
    found = {row["folder"]: row for row in directory_job(spark, str(tmp_path)).collect()}
    assert {name: row["position"] for name, row in found.items()} == {"chr0": 1, "chr1": 2, "chr2": 3}
    (made,) = set(glob.glob(f"{scratch_dir(spark)}/*/query-*")) - before
    assert all(len(glob.glob(f"{made}/tracks/folder=chr{n}/*.bed")) == 4 for n in range(3))


def test_rows_go_to_folders_without_a_sort(spark, monkeypatch):
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(int(spark.conf.get(key))), write(self, *a, **b)))
    rows = spark.range(300, numPartitions=2).withColumn("_kind", (F.col("id") % 20).cast("string"))
    assert sorted(map(tuple, land(rows, by=["_kind"]).collect())) == sorted(map(tuple, rows.collect()))  # more folders than open files
    assert seen[0] > 0 and spark.conf.get(key) == before


def test_records_at_reached_starts_are_not_sorted_for_the_first_one(spark):
    spans = [(0, 100, 1.0), (10, 20, 2.0), (10, 20, 2.0), (10, 30, 0.0), (200, 210, 3.0), (200, 210, 3.0), (200, 200, 9.0), (200, 205, 9.0)]
    rows = spark.createDataFrame([("g", "p", "c", *s) for s in spans], "genome string, path string, chrom string, start long, end long, value double")
    found = intervals.find_overlaps(rows)
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    assert any("Filter" in line and "NOT _reached" in line for line in optimized.splitlines())
    assert sorted(tuple(r)[3:] for r in found.collect()) == [(10, 20, 2.0, 2), (10, 30, 0.0, 1), (200, 210, 3.0, 2)]
