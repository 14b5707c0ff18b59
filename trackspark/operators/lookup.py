"""Joins of a large side with a lookup side, safe for size and for skew.

A lookup side is broadcast only after its rows and bytes have been measured.
Beyond the limit the join is shuffled, and the keys that hold a large share of
the big side are joined apart from the others, so that one key never fills one
task. Which keys count as heavy changes the plan only, never the result.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

# Sketch size of the search for heavy keys.
HEAVY_KEYS = 1_000
SKETCH_ITEMS = 10_000


def row_bytes(schema):
    """About how many bytes a row takes."""
    parts = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            parts.append(8 * F.coalesce(F.size(column), F.lit(0)))  # no text is made of them
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(column.cast("string")), F.lit(0)))
        else:
            parts.append(F.lit(8))
    total = F.lit(16)
    for part in parts:
        total = total + part
    return total


def measure(df, max_rows=BROADCAST_ROWS):
    """(rows, bytes) of ``df``, counting at most ``max_rows + 1`` rows."""
    row = (
        df.select(row_bytes(df.schema).cast("bigint").alias("size"))
        .limit(max_rows + 1)
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
        .first()
    )
    return row["rows"], row["bytes"]


def fits_broadcast(df, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES, measured=None):
    rows, size = measured or measure(df, max_rows)
    return rows <= max_rows and size <= max_bytes


def top_keys(df, on):
    """(rows, {hash of key: estimated rows}) of the most frequent keys, by a one-pass sketch."""
    key = f"xxhash64({', '.join(f'`{c}`' for c in on)})"
    found = df.agg(
        F.count("*").alias("rows"), F.expr(f"approx_top_k({key}, {HEAVY_KEYS}, {SKETCH_ITEMS})").alias("top")
    ).first()
    return found["rows"], {item["item"]: item["count"] for item in found["top"] or []}


def heavy_keys(df, on, min_rows):
    """Hashes of the key values that the sketch estimates at ``min_rows`` or more."""
    return [key for key, count in top_keys(df, on)[1].items() if count >= min_rows]


def lookup_join(left, right, on, how="left", max_rows=BROADCAST_ROWS,
                max_bytes=BROADCAST_BYTES, min_heavy_rows=1_000_000, measured=None):
    """Join ``left`` to the lookup side ``right`` on the columns ``on``.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. ``measured``
    may hand in the size of ``right`` where the caller knows it from ``measure``.
    """
    if fits_broadcast(right, max_rows, max_bytes, measured):
        return left.join(F.broadcast(right), on, how)
    return split_join(left, right, on, how, max_rows, max_bytes, min_heavy_rows)


def split_join(left, right, on, how="left", max_rows=BROADCAST_ROWS,
               max_bytes=BROADCAST_BYTES, min_heavy_rows=1_000_000):
    """Join two large sides on ``on``; keys that are heavy in ``left`` are joined apart."""
    heavy = heavy_keys(left, on, min_heavy_rows)
    if not heavy:
        return left.join(right, on, how)
    is_heavy = F.xxhash64(*on).isin(heavy)
    heavy_right = right.filter(is_heavy)
    if not fits_broadcast(heavy_right, max_rows, max_bytes):
        return left.join(right, on, how)  # many rows per heavy key: left to the adaptive skew join
    hot = left.filter(is_heavy).join(F.broadcast(heavy_right), on, how)
    rest = left.filter(~is_heavy).join(right.filter(~is_heavy), on, how)
    return rest.unionByName(hot)
