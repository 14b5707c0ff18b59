"""Running values along a contig without a task per contig.

A window over (track, contig) would put a third of the data in one task when one
contig holds a third of the rows. Here positions are first folded to one row
each, so a tile of fixed width holds at most ``TILE_WIDTH`` rows however deep
the data is. Windows run within tiles; one small row per tile carries the state
from tile to tile, and their number is bounded by the length of the contig.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

TILE_WIDTH = 1 << 16


def running_before(points, keys, pos, value, fold="max", width=TILE_WIDTH, carry_from=None):
    """Add ``before`` and ``next_pos`` to rows that are unique on (keys, pos).

    ``before`` folds ``value`` over all rows of the same keys at smaller
    positions (``max`` or ``sum``); ``next_pos`` is the position that follows.
    ``carry_from`` may name the unfolded rows behind ``points``: tile totals taken
    from them combine before the shuffle.
    """
    folds = {"max": F.max, "sum": F.sum}
    apply = folds[fold]
    keys = list(keys)
    tile = F.expr(f"`{pos}` div {width}")
    tiled = points.withColumn("_tile", tile)
    source = tiled if carry_from is None else carry_from.withColumn("_tile", tile)
    along = Window.partitionBy(*keys).orderBy("_tile")
    within = Window.partitionBy(*keys, "_tile").orderBy(pos)
    earlier = (Window.unboundedPreceding, -1)

    carries = (
        source.groupBy(*keys, "_tile")
        .agg(apply(value).alias("_total"), F.min(pos).alias("_first"))
        .select(
            *keys,
            "_tile",
            apply("_total").over(along.rowsBetween(*earlier)).alias("_carry"),
            F.lead("_first").over(along).alias("_next_first"),
        )
    )
    scanned = tiled.select(
        "*",
        apply(value).over(within.rowsBetween(*earlier)).alias("_local"),
        F.lead(pos).over(within).alias("_local_next"),
    )
    before = (
        F.greatest("_local", "_carry")
        if fold == "max"
        else F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    )
    return scanned.join(carries, keys + ["_tile"]).select(
        *[F.col(c) for c in points.columns],
        before.alias("before"),
        F.coalesce("_local_next", "_next_first").alias("next_pos"),
    )
