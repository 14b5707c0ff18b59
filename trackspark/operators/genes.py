"""Gene models: features to transcripts with exon arrays, and on to bigGenePred rows."""

from pyspark.sql import functions as F

from ..functions import gff as G
from ..schemas import BIG_GENE_PRED
from .lookup import lookup_join
from .scratch import land

PIECES = ["exon", "CDS"]


def pieces_of(gff, keys=("genome", "path")):
    """Exon and CDS rows, one per parent: (keys, transcript_id, kind, chrom, strand, start, end, phase)."""
    # A plain explode would have the parents searched for in a filter before it, and then again.
    each = gff.filter(F.col("type").isin(PIECES)).select("*", F.posexplode_outer("parents").alias("_place", "transcript_id"))
    return each.filter("_place is not null").select(
        *keys,
        "transcript_id",
        F.col("type").alias("kind"),
        "chrom",
        "strand",
        "start",
        "end",
        "phase",
    )


def feature_nodes(gff, keys=("genome", "path")):
    """Features that may be parents, one row per id."""
    gene_type = F.coalesce(*[G.attribute("attributes", k) for k in ("gene_biotype", "biotype", "gene_type")])
    features = gff.filter(~F.col("type").isin(PIECES) & F.col("id").isNotNull()).select(
        *keys,
        "id",
        F.struct(
            "start",
            "end",
            "type",
            "name",
            F.get("parents", F.lit(0)).alias("parent"),
            gene_type.alias("biotype"),
        ).alias("node"),
    )
    # Sorted by id first, as the keys are the same for many rows.
    return features.groupBy("id", *keys).agg(F.min("node").alias("node")).select(*keys, "id", "node")


def top_ancestors(links, keys=("genome", "path")):
    """(keys, id, top, depth, cycle): the topmost ancestor of every feature, however deep, by pointer doubling.

    ``links`` is (keys, id, parent), one row per id; a parent that is no feature itself is a top. Every round doubles the
    distance that a pointer spans, and settles at least the features just beyond the last distance as long as any is on a chain. When a round
    settles none, those left are in a cycle, or lead into one: their top is null.
    """
    keys = list(keys)
    settled = land(links.filter("parent is null").select(*keys, "id", F.col("id").alias("top"), F.lit(0).alias("depth")))
    open_ = land(links.filter("parent is not null").select(*keys, "id", F.col("parent").alias("up"), F.lit(1).alias("depth")))
    left = open_.count()
    while left:
        ahead = settled.select(*keys, F.col("id").alias("up"), F.col("top").alias("_up"), F.col("depth").alias("_more"), F.lit(True).alias("_done"))
        ahead = ahead.unionByName(open_.select(
            *keys, F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_more"), F.lit(False).alias("_done")))
        met = land(open_.join(ahead, [*keys, "up"], "left").select(
            *keys, "id", F.coalesce("_up", "up").alias("up"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
            F.coalesce("_done", F.lit(True)).alias("_done")))
        settled = settled.unionByName(met.filter("_done").select(*keys, "id", F.col("up").alias("top"), "depth"))
        open_ = met.filter("not _done").drop("_done")
        before, left = left, open_.count()
        if left == before:
            break
    none = open_.select(*keys, "id", F.lit(None).cast("string").alias("top"), F.lit(None).cast("int").alias("depth"), F.lit(True).alias("cycle"))
    return settled.withColumn("cycle", F.lit(False)).unionByName(none)


def _named_transcripts(nodes, keys):
    """Transcripts with the names of their genes, and whether their ancestors form a cycle.

    The gene of a transcript is its topmost ancestor. Nearly always that is its parent, or itself where a gene holds exons: one join
    finds it. Only features whose parents have parents go on to ``top_ancestors``.
    """
    keys = list(keys)
    nodes = land(nodes)  # attributes are searched once
    up = nodes.select(*keys, F.col("id").alias("_up"), F.col("node").alias("_up_node"))
    # Neither side is known to be small: adaptive execution broadcasts by measured
    # size and splits skewed partitions.
    first = land(nodes.withColumn("_up", F.col("node.parent")).join(up, ["_up", *keys], "left"))
    deep = F.coalesce(F.col("_up_node.parent").isNotNull(), F.lit(False))
    near = first.filter(~deep).select(
        *keys, "id", "node", F.coalesce("_up", "id").alias("top"),
        F.when(F.col("_up").isNull(), F.col("node")).otherwise(F.col("_up_node")).alias("top_node"), F.lit(False).alias("parent_cycle"))
    far = first.filter(deep).select(*keys, "id", "node")
    if far.limit(1).count():
        tops = top_ancestors(first.select(*keys, "id", F.col("_up").alias("parent")), keys).drop("depth")
        tops = far.join(tops, [*keys, "id"]).withColumnRenamed("cycle", "parent_cycle").withColumnRenamed("top", "_up")
        near = near.unionByName(tops.join(up, [*keys, "_up"], "left").withColumnsRenamed({"_up": "top", "_up_node": "top_node"}))
    return near.select(
        *keys,
        F.col("id").alias("transcript_id"),
        F.col("node.type").alias("transcript_type"),
        F.col("node.name").alias("transcript_name"),
        F.col("top").alias("gene_id"),
        F.col("top_node.name").alias("gene_name"),
        F.coalesce("top_node.biotype", "top_node.type").alias("gene_type"),
        "parent_cycle",
    )


def feature_tree(gff, keys=("genome", "path")):
    """Each exon and CDS with its transcript and gene; columns are null where a parent is missing."""
    named = _named_transcripts(feature_nodes(gff, keys), keys).drop("parent_cycle")
    return lookup_join(pieces_of(gff, keys), named, [*keys, "transcript_id"])


def orphan_pieces(gff, keys=("genome", "path")):
    """Exon and CDS rows without a parent, counted: (keys, transcript_id, reason, pieces) with a null id."""
    alone = gff.filter(F.col("type").isin(PIECES) & (F.coalesce(F.size("parents"), F.lit(0)) <= 0))
    return alone.groupBy(*keys).agg(F.count("*").alias("pieces")).select(
        *keys, F.lit(None).cast("string").alias("transcript_id"), F.lit("missing_parent").alias("reason"), "pieces")


def gene_models(gff, keys=("genome", "path")):
    """(models, rejects): one row per transcript with its exon arrays.

    Rejected transcripts carry a ``reason``; they never fail the job. See
    ``transcripts_of`` for the rules. Pieces without any parent are rejected together, with a null id.
    """
    transcripts = transcripts_of(pieces_of(gff, keys), keys)
    # Pieces are already one row per transcript here, so no key of this join is heavy.
    named = transcripts.join(
        _named_transcripts(feature_nodes(gff, keys), keys), ["transcript_id", *keys], "left"
    )
    reason = F.when(F.col("transcript_type").isNull(), "missing_parent").when(F.col("parent_cycle"), "parent_cycle").otherwise(F.col("reason"))
    tagged = named.withColumn("reason", reason)
    models = tagged.filter("reason is null").select(
        *keys,
        "chrom",
        "strand",
        "tx_start",
        "tx_end",
        "cds_start",
        "cds_end",
        "exon_starts",
        "exon_ends",
        "exon_frames",
        F.coalesce("transcript_name", "transcript_id").alias("name"),
        F.coalesce("gene_name", "gene_id").alias("name2"),
        "transcript_id",
        "transcript_type",
        "gene_id",
        "gene_name",
        "gene_type",
    )
    rejects = tagged.filter("reason is not null").select(*keys, "transcript_id", "reason", "pieces")
    return models, rejects.unionByName(orphan_pieces(gff, keys))


def transcripts_of(pieces, keys=("genome", "path")):
    """Transcripts from exon and CDS pieces, before they meet their names: one row each, at every size.

    Equal pieces count once, and are merged before the shuffle. Without exons the CDS pieces act as exons; without
    CDS the transcript is non-coding and its coding range is empty, at its end.
    ``reason`` is set for a transcript on several contigs or strands, with an
    empty or unreadable span, with overlapping exons, or with CDS beyond its exons.
    A transcript is one row of a BED12+8 table, exon lists included, so its pieces meet in one row.
    """
    return _gathered(pieces, [*keys, "transcript_id"])


def _faults(mixed_contig, mixed_strand, bad_span, overlapping, cds_outside):
    return (
        F.when(mixed_contig, "mixed_contig")
        .when(mixed_strand, "mixed_strand")
        .when(bad_span, "bad_span")
        .when(overlapping, "overlapping_exons")
        .when(cds_outside, "cds_outside_exons")
    )


def _bad_span():
    return F.coalesce(F.col("start") >= F.col("end"), F.lit(True))


def _gathered(pieces, group):
    """One row per transcript: its exons and CDS are gathered, sorted and checked as arrays.

    The last key of the group leads the sort, as many rows share the others.
    """
    kind, span = F.col("kind"), ["start", "end"]
    gathered = pieces.groupBy(*reversed(group)).agg(
        F.collect_set(F.when(kind == "exon", F.struct(*span))).alias("exons"),
        F.collect_set(F.when(kind == "CDS", F.struct(*span, "phase"))).alias("cds"),
        F.min("chrom").alias("chrom"),
        F.max("chrom").alias("last_chrom"),
        F.min("strand").alias("strand"),
        F.max("strand").alias("last_strand"),
        F.max(_bad_span()).alias("bad_span"),
        F.count("*").alias("rows"),
    )
    gathered = gathered.withColumns({"exons": F.sort_array("exons"), "cds": F.sort_array("cds")})
    as_exons = F.array_distinct(F.transform("cds", lambda p: F.struct(p["start"], p["end"])))
    gathered = gathered.withColumn("exons", F.when(F.size("exons") > 0, F.col("exons")).otherwise(as_exons))
    gathered = gathered.withColumn("exon_starts", F.col("exons")["start"]).withColumn("exon_ends", F.col("exons")["end"])
    tx_start, tx_end = F.array_min("exon_starts"), F.array_max("exon_ends")
    coding = F.size("cds") > 0
    cds_start = F.when(coding, F.array_min(F.col("cds")["start"])).otherwise(tx_end)
    cds_end = F.when(coding, F.array_max(F.col("cds")["end"])).otherwise(tx_end)
    # Each start but the first meets the end before it.
    later = F.slice("exon_starts", F.lit(2), F.size("exon_starts"))
    clashes = F.zip_with(later, "exon_ends", lambda start, before: start < before)
    overlapping = F.coalesce(F.array_contains(clashes, True), F.lit(False))
    return gathered.select(
        *group,
        "chrom",
        "strand",
        tx_start.alias("tx_start"),
        tx_end.alias("tx_end"),
        cds_start.alias("cds_start"),
        cds_end.alias("cds_end"),
        "exon_starts",
        "exon_ends",
        G.exon_frames(F.col("exons"), F.col("cds")).alias("exon_frames"),
        F.col("rows").alias("pieces"),
        _faults(
            F.col("chrom") != F.col("last_chrom"),
            F.col("strand") != F.col("last_strand"),
            F.col("bad_span"),
            overlapping,
            (cds_start < tx_start) | (cds_end > tx_end),
        ).alias("reason"),
    )


def to_biggenepred(models, extra=()):
    """Gene models as bigGenePred rows (BED12+8); block starts count from the start of the row."""
    coding = F.col("cds_start") < F.col("cds_end")
    status = F.when(coding, "cmpl").otherwise("none")
    values = {
        "chrom": F.col("chrom"),
        "chromStart": F.col("tx_start"),
        "chromEnd": F.col("tx_end"),
        "name": F.col("name"),
        "score": F.lit(0),
        "strand": F.col("strand"),
        "thickStart": F.col("cds_start"),
        "thickEnd": F.col("cds_end"),
        "reserved": F.lit(0),
        "blockCount": F.size("exon_starts"),
        "blockSizes": F.zip_with("exon_ends", "exon_starts", lambda end, start: end - start),
        "chromStarts": F.transform("exon_starts", lambda start: start - F.col("tx_start")),
        "name2": F.col("name2"),
        "cdsStartStat": status,
        "cdsEndStat": status,
        "exonFrames": F.col("exon_frames"),
        "type": F.col("transcript_type"),
        "geneName": F.coalesce("gene_name", "gene_id"),
        "geneName2": F.col("gene_id"),
        "geneType": F.coalesce("gene_type", F.lit("none")),
    }
    return models.select(*extra, *[values[name].cast(kind).alias(name) for name, kind in BIG_GENE_PRED])
