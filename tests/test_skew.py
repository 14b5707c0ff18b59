"""One contig, start, record or parent holds a third of the rows or more."""

import random

from conftest import rows
from pyspark.sql import functions as F

from trackspark.operators import catalog, genes, intervals, lookup, signal, tiles
from trackspark.sinks.tracks import clustered


def brute_overlaps(records):
    out, reach = {}, {}
    for key, start, end, value in sorted(records):
        if key in reach and reach[key] > start:
            out[(key, start, end, value)] = out.get((key, start, end, value), 0) + 1
        reach[key] = max(reach.get(key, end), end)
    return sorted((*record, n) for record, n in out.items())


def brute_depth(records):
    out = []
    for key in sorted({r[0] for r in records}):
        steps = {}
        for k, start, end, _ in records:
            if k == key and start < end:
                steps[start] = steps.get(start, 0) + 1
                steps[end] = steps.get(end, 0) - 1
        at = sorted(p for p in steps if steps[p])
        depth = 0
        for here, after in zip(at, at[1:]):
            depth += steps[here]
            if depth > 0:
                out.append((key, here, after, depth))
    return sorted(out)


def skewed(seed, n=300):
    rng = random.Random(seed)
    records = [("a", 100, 130, 1)] * (n // 3)  # copies of one record
    records += [("a", 100, 100 + rng.randint(0, 40), rng.randint(1, 3)) for _ in range(n // 3)]  # one start
    for _ in range(n // 3):
        start = rng.randint(0, 2000)
        records.append((rng.choice("abc"), start, start + rng.choice([0, 1, 5, 600]), rng.randint(1, 3)))
    return records


def test_overlaps_and_depth_match_brute_force(spark):
    for seed in range(3):
        records = skewed(seed)
        df = spark.createDataFrame(records, "chrom string, start bigint, end bigint, value bigint")
        for width in (16, 1 << 16):
            got = intervals.find_overlaps(df, keys=("chrom",), width=width)
            assert sorted(tuple(r) for r in got.collect()) == brute_overlaps(records)
            depth = intervals.coverage_depth(df, keys=("chrom",), width=width)
            assert sorted(tuple(r) for r in depth.collect()) == brute_depth(records)


def test_tile_windows_hold_a_row_per_position(spark):
    df = spark.range(5000).select(F.lit("a").alias("k"), F.lit(7).alias("pos"), F.lit(1).alias("v"))
    points = df.groupBy("k", "pos").agg(F.sum("v").alias("v"))
    assert rows(tiles.running_before(points, ["k"], "pos", "v", "sum")) == [("a", 7, 5000, 0, None)]


def test_split_join_equals_a_plain_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v")
    )
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = rows(left.join(right, ["k"], how))
        split = lookup.lookup_join(left, right, ["k"], how, max_rows=100, min_heavy_rows=50)
        assert rows(split) == want
    # so many rows per heavy key that even they are not broadcast
    many = right.unionByName(spark.range(300).select(F.lit(0).cast("bigint").alias("k"), F.col("id").alias("w")))
    assert lookup.lookup_join(left, many, ["k"], "inner", max_rows=100, min_heavy_rows=50).count() == left.join(
        many, "k"
    ).count()


def test_heavy_keys_are_found(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert len(lookup.heavy_keys(df, ["k"], 1000)) == 1


def test_broadcast_limit_counts_bytes(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("text"), F.array("id").alias("a"))
    assert lookup.fits_broadcast(df)
    assert not lookup.fits_broadcast(df, max_bytes=5000)
    assert not lookup.fits_broadcast(df, max_rows=9)


def test_copies_are_spread_over_output_ranges(spark):
    df = spark.range(0, 4000, 1, 8).select(
        F.lit("g").alias("genome"), F.lit("chr1").alias("chrom"), F.lit(5).alias("start"), F.lit(9).alias("end")
    )
    sizes = clustered(df, 4).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) < 2500


def test_groups_are_rows_at_every_size(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2000, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 10)).alias("sample_id"),
        F.concat(F.lit("p"), F.col("id")).alias("path"),
    )
    df = df.unionByName(df.filter("sample_id = 's1'"))
    groups = catalog.group_tracks(df)
    assert rows(groups, "sample_id", "path") == rows(df.distinct())
    assert groups.agg(F.sum("tracks")).first()[0] == df.count()


def test_summary_levels_agree(spark):
    df = spark.createDataFrame(
        [("a", 0, 1000, 2.0), ("a", 1000, 1001, -3.0), ("a", 1500, 9000, 0.5), ("a", 20, 20, 9.0), ("b", 7, 8, 1.0)],
        "chrom string, start bigint, end bigint, value double",
    )
    out = signal.summarise_signal(df, [10, 40, 60, 1000], keys=("chrom",))
    by_level = out.groupBy("reduction").agg(F.sum("covered").alias("c"), F.sum("total").alias("t")).collect()
    assert {(r["c"], round(r["t"], 6)) for r in by_level} == {(8502, 5748.0)}
    for width in (10, 40, 60, 1000):
        direct = rows(signal.bin_signal(df, width, keys=("chrom",)))
        assert rows(out.filter(f"reduction = {width}").drop("reduction")) == direct
    worked = out.filter("reduction = 1000 and chrom = 'a' and bin = 1").first()
    assert (worked["covered"], worked["total"], worked["low"], worked["high"]) == (501, 247.0, -3.0, 0.5)


def test_a_long_span_reaches_every_bin(spark):
    df = spark.createDataFrame([("a", 5, 100_005, 2.0)], "chrom string, start bigint, end bigint, value double")
    out = signal.bin_signal(df, 10, keys=("chrom",))
    got = out.agg(F.count("*"), F.sum("covered"), F.min("bin"), F.max("bin"), F.min("covered")).first()
    assert tuple(got) == (10_001, 100_000, 0, 10_000, 5)


def model_features(spark, n_exons):
    """One transcript of many exons, with CDS in the middle; a few small ones."""
    data = []
    for tx, n in (("wide", n_exons), ("small", 3)):
        for i in range(n):
            start = i * 100
            data.append(("g", tx, "exon", "chr1", "+", start, start + 50, None))
            if 0 < i < n - 1:
                data.append(("g", tx, "CDS", "chr1", "+", start + 2, start + 40, i % 3))
    data += [("g", "cdsonly", "CDS", "chr1", "-", i * 10, i * 10 + 5, 1) for i in range(n_exons)]
    data += [("g", "clash", "exon", "chr1", "-", i, i + 5, None) for i in range(n_exons)]
    data += data[:n_exons]  # copies
    return spark.createDataFrame(
        data, "genome string, transcript_id string, kind string, chrom string, strand string, "
        "start bigint, end bigint, phase int"
    )


def test_every_transcript_is_one_row(spark):
    whole = genes.transcripts_of(model_features(spark, 3000), ("genome",))
    assert rows(whole, "transcript_id", F.size("exon_starts"), "reason") == [
        ("cdsonly", 3000, None), ("clash", 3000, "overlapping_exons"), ("small", 3, None), ("wide", 3000, None)]


def test_a_coding_piece_frames_every_exon_it_overlaps(spark):
    data = [("g", "t", "exon", "chr1", "+", 0, 50, None), ("g", "t", "exon", "chr1", "+", 100, 150, None),
            ("g", "t", "CDS", "chr1", "+", 40, 120, 1)]
    pieces = spark.createDataFrame(data, model_features(spark, 2).schema)
    assert rows(genes.transcripts_of(pieces, ("genome",)), "exon_frames") == [([2, 2],)]


def test_pieces_without_a_parent_are_rejected(spark):
    gff = spark.createDataFrame(
        [("g", "exon", None), ("g", "CDS", []), ("g", "gene", None)], "genome string, type string, parents array<string>"
    ).selectExpr("*", "'chr1' chrom", "'+' strand", "0L start", "9L end", "0 phase", "cast(null as string) id",
                 "cast(null as string) name", "cast(null as string) attributes")
    assert rows(genes.orphan_pieces(gff, ("genome",))) == [("g", None, "missing_parent", 2)]


