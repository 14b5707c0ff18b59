"""Connected components by alternating large-star and small-star."""

from pyspark.sql import functions as F

from .common import land


def _settled(edges):
    """Whether every node has one edge, to a node that has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    open_ = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or out = 1 and into = 1")
    return not open_.limit(1).count()


def _large_star(edges):
    """Every node hands its larger neighbours to its least neighbour, or to itself where it is less."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges):
    """Every node hands its lesser neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    moved = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges, rounds=100):
    """(node, component): the least node reachable from each node that has an edge to a lesser one.

    ``edges`` is (u, v), in either direction; loops and nulls are ignored. Nodes without a row are components
    of their own least node. Rounds needed grow with the logarithm of the
    longest path; each round lands its edges, at most as many as before.
    """
    edges = land(edges.filter("u is not null and v is not null and u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(rounds):
        if _settled(edges):
            break
        edges = land(_small_star(_large_star(edges)))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
