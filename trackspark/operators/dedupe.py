"""One row per key, chosen by an explicit order."""

from pyspark.sql import functions as F


def dedupe(df, keys, keep="first", order=None):
    """Keep one row per ``keys``: the ``first`` or ``last`` by the column ``order``.

    Without an order the rows must be equal, and this is a plain distinct.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order is None:
        return df.select(*keys).distinct()
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    pick = F.min_by if keep == "first" else F.max_by
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*others), F.col(order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
