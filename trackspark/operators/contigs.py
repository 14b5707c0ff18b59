"""Contig names: match records to the chromosome-size table of their assembly.

A record's contig ``c`` is matched against the names ``S`` of its assembly:

1. ``c`` itself, if in ``S``;
2. ``chrM`` for ``M`` and ``MT``, else ``chr`` + ``c``, if in ``S``;
3. ``c`` without a leading ``chr`` (``M`` and ``MT`` both read as ``MT``), if in ``S``;
4. otherwise the record keeps its contig and counts as missing.

The rule is turned round: each name in ``S`` is expanded to the spellings that
lead to it, so matching is one equi-join whatever the number of records.
"""

from pyspark.sql import functions as F

from .lookup import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join, measure

# Spellings of the mitochondrial contig.
MITO_BARE = ["M", "MT"]
MITO_PREFIXED = ["chrM", "chrMT"]

# Fixed value: missing contigs named in a message.
SHOWN = 50


class MissingContigsError(ValueError):
    """Raised in error mode when records lie on contigs the assembly does not list."""


class EmptySizesError(ValueError):
    """Raised when a chromosome-size table has no rows."""


def contig_aliases(sizes, on="genome"):
    """One row per spelling a record may use: (genome, chrom, contig, contig_size)."""
    keys = [on] if on else []
    name = F.col("name")
    bare = F.substring(name, 4, 1 << 30)

    def spelling(alias, rank):
        return F.struct(alias.alias("chrom"), F.lit(rank).alias("rank"))

    def only(condition, *items):
        return F.when(condition, F.array(*items)).otherwise(F.array().cast("array<struct<chrom:string,rank:int>>"))

    spellings = F.concat(
        F.array(spelling(name, 0)),
        only(name.startswith("chr") & ~name.isin(MITO_PREFIXED), spelling(bare, 1)),
        only(name == "chrM", *[spelling(F.lit(m), 1) for m in MITO_BARE]),
        only(name == "MT", *[spelling(F.lit(m), 2) for m in MITO_PREFIXED]),
        only(~name.isin(MITO_BARE), spelling(F.concat(F.lit("chr"), name), 2)),
    )
    best = F.min(F.struct("rank", F.col("name").alias("contig"), F.col("size").alias("contig_size")))
    return (
        sizes.select(*keys, "name", "size", F.inline(spellings))
        .groupBy(*keys, "chrom")
        .agg(best.alias("best"))
        .select(*keys, "chrom", "best.contig", "best.contig_size")
    )


def harmonise_contigs(df, sizes, on="genome", max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES):
    """Rename each record's ``chrom`` to its assembly's spelling.

    Adds ``contig_size`` and ``known``; a record with ``known = false`` lies on
    a missing contig and keeps its own name. One join serves renaming, dropping
    and auditing.
    """
    aliases = contig_aliases(sizes, on)
    measured = measure(aliases, max_rows)
    if not measured[0]:
        raise EmptySizesError("the chromosome-size table has no rows")
    keys = ([on] if on else []) + ["chrom"]
    joined = lookup_join(df, aliases, keys, "left", max_rows, max_bytes, measured=measured)
    kept = [c for c in df.columns if c != "chrom"]
    return joined.select(
        F.coalesce("contig", "chrom").alias("chrom"),
        *kept,
        "contig_size",
        F.col("contig").isNotNull().alias("known"),
    )


def drop_missing_contigs(df, sizes, on="genome"):
    """Harmonised records whose contig the assembly lists."""
    return harmonise_contigs(df, sizes, on).filter("known").drop("known")


def missing_contigs(df, sizes, on="genome"):
    """Contigs the assembly does not list, with the number of records on each."""
    return audit_missing(harmonise_contigs(df, sizes, on), on)


def audit_missing(harmonised, on="genome"):
    """The missing-contig audit of records that are already harmonised."""
    keys = ([on] if on else []) + ["chrom"]
    return harmonised.filter(~F.col("known")).groupBy(*keys).agg(F.count("*").alias("records"))


def first_missing(harmonised, on="genome", shown=SHOWN):
    """The first missing contigs by name, as many as a message shows."""
    keys = ([on] if on else []) + ["chrom"]
    return audit_missing(harmonised, on).orderBy(*keys).limit(shown)


def resolve_missing(harmonised, on_missing="drop", on="genome", shown=SHOWN):
    """Apply the missing-contig mode: ``drop`` the records or raise an ``error``."""
    if on_missing not in ("drop", "error"):
        raise ValueError(f"on_missing must be 'drop' or 'error', not {on_missing!r}")
    if on_missing == "error":
        listed = first_missing(harmonised, on, shown).collect()
        if listed:
            names = ", ".join("/".join(str(row[c]) for c in row.__fields__[:-1]) for row in listed)
            raise MissingContigsError(f"contigs absent from the chromosome sizes: {names}")
    return harmonised.filter("known").drop("known")
