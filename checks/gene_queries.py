"""Gene-model queries: GFF3 text made from customers, orders and lineitems, parsed and assembled."""

from pyspark.sql import functions as F

from trackspark.functions import gff as G
from trackspark.functions import values as V
from trackspark.operators import genes, sizes
from trackspark.operators.scratch import land
from trackspark.plans.jobs import gene_rows
from trackspark.sources import records

from . import inputs as I
from .registry import query

KEYS = ("genome",)


def _features(spark, sf_dir):
    """Parsed once and landed, since each query goes over the features more than once."""
    return records.with_attributes(land(_fields(spark, sf_dir)))


def _fields(spark, sf_dir):
    return records.gff3_fields(I.gff_lines(spark, sf_dir), "AdditionalSources")


ASSEMBLED = f"""
{I.PIECES}, {I.NODES},
distinct_pieces as (select distinct * from piece_rows),
stats as (
  select transcript_id, count(*) as pieces, min(chrom) as chrom, min(chrom) <> max(chrom) as mixed_contig,
         min(strand) as strand, min(strand) <> max(strand) as mixed_strand,
         count(*) filter (where kind = 'exon') > 0 as has_exons,
         min(piece_start) filter (where kind = 'CDS') as cds_start,
         max(piece_end) filter (where kind = 'CDS') as cds_end
  from piece_rows group by transcript_id),
exons as (
  select distinct p.transcript_id, piece_start, piece_end
  from distinct_pieces p join stats s using (transcript_id)
  where p.kind = case when s.has_exons then 'exon' else 'CDS' end),
ordered_exons as (
  select *, lag(piece_end) over (partition by transcript_id order by piece_start, piece_end) as before_end
  from exons),
framed as (
  select e.*, (select (3 - c.phase) % 3 from distinct_pieces c
               where c.transcript_id = e.transcript_id and c.kind = 'CDS'
                 and c.piece_start < e.piece_end and c.piece_end > e.piece_start
               order by c.piece_start, c.piece_end, c.phase limit 1) as frame
  from ordered_exons e),
arrays as (
  select transcript_id, min(piece_start) as tx_start, max(piece_end) as tx_end, count(*) as exon_count,
         string_agg(cast(piece_start as varchar), ',' order by piece_start, piece_end) || ',' as exon_starts,
         string_agg(cast(piece_end as varchar), ',' order by piece_start, piece_end) || ',' as exon_ends,
         string_agg(cast(coalesce(frame, -1) as varchar), ',' order by piece_start, piece_end) || ',' as exon_frames,
         coalesce(bool_or(piece_start < before_end), false) as overlapping
  from framed group by transcript_id),
assembled as (
  select a.*, s.chrom, s.strand, s.pieces,
         coalesce(s.cds_start, a.tx_end) as cds_start, coalesce(s.cds_end, a.tx_end) as cds_end,
         n.transcript_type, n.transcript_name, n.gene_id, n.gene_name, n.gene_type,
         case when n.transcript_type is null then 'missing_parent' when s.mixed_contig then 'mixed_contig'
              when s.mixed_strand then 'mixed_strand' when a.overlapping then 'overlapping_exons'
              when s.cds_start < a.tx_start or s.cds_end > a.tx_end then 'cds_outside_exons' end as reason
  from arrays a join stats s using (transcript_id) left join named n using (transcript_id))
"""


@query("feature_tree", f"""
with {I.PIECES}, {I.NODES}
select p.transcript_id, kind, chrom, strand, piece_start, piece_end, phase, transcript_name, gene_id, gene_name,
       gene_type, count(*) as records
from piece_rows p left join named n using (transcript_id) group by all
""")
def feature_tree(spark, sf_dir):
    tree = genes.feature_tree(_features(spark, sf_dir), KEYS)
    return tree.groupBy(
        "transcript_id", "kind", "chrom", "strand", F.col("start").alias("piece_start"),
        F.col("end").alias("piece_end"), "phase", "transcript_name", "gene_id", "gene_name", "gene_type",
    ).agg(F.count("*").alias("records"))


@query("gene_models", f"""
with {ASSEMBLED}
select transcript_id, chrom, strand, tx_start, tx_end, cds_start, cds_end, exon_starts, exon_ends, exon_frames,
       coalesce(transcript_name, transcript_id) as name, coalesce(gene_name, gene_id) as name2
from assembled where reason is null
""")
def gene_models(spark, sf_dir):
    models, _ = genes.gene_models(_features(spark, sf_dir), KEYS)
    return models.select(
        "transcript_id", "chrom", "strand", "tx_start", "tx_end", "cds_start", "cds_end",
        *[V.joined_list(c).alias(c) for c in ("exon_starts", "exon_ends", "exon_frames")], "name", "name2",
    )


@query("gene_model_rejects", f"""
with {ASSEMBLED} select transcript_id, reason, pieces from assembled where reason is not null
""")
def gene_model_rejects(spark, sf_dir):
    _, rejects = genes.gene_models(_features(spark, sf_dir), KEYS)
    return rejects.select("transcript_id", "reason", "pieces")


@query("biggenepred_rows", f"""
with {ASSEMBLED}
select chrom, tx_start, tx_end, coalesce(transcript_name, transcript_id) as name, strand, cds_start, cds_end,
       cast(exon_count as integer) as blocks,
       (select string_agg(cast(e.piece_end - e.piece_start as varchar), ',' order by e.piece_start) || ','
        from exons e where e.transcript_id = a.transcript_id) as sizes,
       (select string_agg(cast(e.piece_start - a.tx_start as varchar), ',' order by e.piece_start) || ','
        from exons e where e.transcript_id = a.transcript_id) as starts,
       exon_frames as frames, case when cds_start < cds_end then 'cmpl' else 'none' end as cds_stat,
       transcript_type as kind, gene_id, gene_type
from assembled a where reason is null
""")
def biggenepred_rows(spark, sf_dir):
    models, _ = genes.gene_models(_features(spark, sf_dir), KEYS)
    rows = genes.to_biggenepred(models)
    return rows.select(
        "chrom", F.col("chromStart").alias("tx_start"), F.col("chromEnd").alias("tx_end"), "name", "strand",
        F.col("thickStart").alias("cds_start"), F.col("thickEnd").alias("cds_end"),
        F.col("blockCount").alias("blocks"), V.joined_list("blockSizes").alias("sizes"),
        V.joined_list("chromStarts").alias("starts"), V.joined_list("exonFrames").alias("frames"),
        F.col("cdsStartStat").alias("cds_stat"), F.col("type").alias("kind"), F.col("geneName2").alias("gene_id"),
        F.col("geneType").alias("gene_type"),
    )


@query("gene_tracks_on_contigs", f"""
with {ASSEMBLED}, {I.SIZES}
select s.name as chrom, count(*) as models, cast(sum(exon_count) as bigint) as exons,
       cast(sum(a.tx_end - a.tx_start) as bigint) as bases
from assembled a join sizes s on s.name = a.chrom or s.name = substr(a.chrom, 4)
where reason is null and tx_end <= s.size group by s.name
""")
def gene_tracks_on_contigs(spark, sf_dir):
    rows = gene_rows(_features(spark, sf_dir), I.sizes(spark, sf_dir), keys=KEYS).track.clean
    return rows.groupBy("chrom").agg(
        F.count("*").alias("models"),
        F.sum("blockCount").alias("exons"),
        F.sum(F.col("chromEnd") - F.col("chromStart")).alias("bases"),
    )


@query("biggenepred_text_scan", f"""
with {ASSEMBLED}
select chrom, tx_start, tx_end, coalesce(gene_name, gene_id) as name2, exon_frames as frames, count(*) as models
from assembled where reason is null group by all
""")
def biggenepred_text_scan(spark, sf_dir):
    from trackspark.sinks.tracks import biggenepred_lines

    models, _ = genes.gene_models(_features(spark, sf_dir), KEYS)
    parsed = records.parse_biggenepred(biggenepred_lines(genes.to_biggenepred(models)))
    return parsed.groupBy(
        "chrom", F.col("chromStart").alias("tx_start"), F.col("chromEnd").alias("tx_end"), "name2",
        V.joined_list("exonFrames").alias("frames"),
    ).agg(F.count("*").alias("models"))


@query("gff3_seqids", """
select distinct 'asm' as genome, 'chr' || cast(l_orderkey % 22 + 1 as varchar(2)) as seqid from lineitem
""")
def gff3_seqids(spark, sf_dir):
    return sizes.gff_seqids(_fields(spark, sf_dir))


@query("gff3_attribute_strip", """
select o_orderkey, 'ID=t' || o_orderkey || case when o_orderkey % 3 = 0 then '' else ';Extra=' || o_custkey end
       || case when o_orderkey % 2 = 0 then ';AdditionalSources=again' else '' end as attributes
from orders
""")
def gff3_attribute_strip(spark, sf_dir):
    text = F.expr(
        "'ID=t' || o_orderkey || case when o_orderkey % 3 = 0 then ';AdditionalSources=x,' || o_custkey "
        "else ';AdditionalSources=;Extra=' || o_custkey end || "
        "case when o_orderkey % 2 = 0 then ';AdditionalSources=again' else '' end"
    )
    return I.table(spark, sf_dir, "orders").select(
        "o_orderkey", G.without_attribute(text, "AdditionalSources").alias("attributes")
    )


@query("gff3_attribute_values", """
select c_custkey, c_name || ' + 100%' as label, 'first' as first_note,
       '2:a,' || cast(c_custkey as varchar) as both_parents, 4 as pairs
from customer
""")
def gff3_attribute_values(spark, sf_dir):
    text = F.expr(
        "'Name=' || replace(c_name, '#', '%23') || '%20+%20100%25;Note=first;Note=second;Parent=a,' || c_custkey"
    )
    rows = I.table(spark, sf_dir, "customer").withColumn("attributes", text)
    parents = G.attribute_list("attributes", "Parent")
    return rows.select(
        "c_custkey",
        G.attribute("attributes", "Name").alias("label"),
        G.attribute("attributes", "Note").alias("first_note"),
        F.concat(F.size(parents).cast("string"), F.lit(":"), F.concat_ws(",", parents)).alias("both_parents"),
        F.size(G.attribute_pairs("attributes")).alias("pairs"),
    )


# Chains of up to six features below a top one; every tenth block of seven is a cycle.
_PARENT = """case when k % 7 = 0 and (k div 7) % 10 = 3 then 'n' || cast(k + 6 as string)
                  when k % 7 > 0 then 'n' || cast(k - 1 as string) end"""


@query("feature_ancestors", f"""
with recursive links as (
  select 'n' || k as id, {_PARENT.replace('div', '//').replace('string', 'varchar')} as parent from (select p_partkey as k from part)),
walk as (
  select id, id as up_id, 0 as depth, false as cycle from links
  union all
  select w.id, l.parent, w.depth + 1, l.parent = w.id from walk w join links l on l.id = w.up_id
  where l.parent is not null and not w.cycle and w.depth < 8),
last as (select id, arg_max(up_id, depth) as top, max(depth) as depth, bool_or(cycle) as cycle from walk group by id)
select id, case when not cycle then top end as top, case when not cycle then cast(depth as integer) end as depth, cycle from last
""")
def feature_ancestors(spark, sf_dir):
    """The topmost ancestor of features in chains of depth 6, with parents that are missing and parents that form a cycle."""
    links = I.table(spark, sf_dir, "part").selectExpr("p_partkey as k").select(
        F.lit("asm").alias("genome"), F.expr("'n' || cast(k as string)").alias("id"), F.expr(_PARENT).alias("parent"))
    return genes.top_ancestors(links, ["genome"]).select("id", "top", "depth", "cycle")


@query("deep_gene_models", f"""
with lines as (
  select l_partkey as k, l_linenumber * 1000 as s, l_linenumber * 1000 + 10 as e from lineitem),
pieces as (
  select k, min(s) as tx_start, max(e) as tx_end from lines where k % 7 > 3 group by k)
select 'n' || k as transcript_id, cast(tx_start as bigint) as tx_start, cast(tx_end as bigint) as tx_end,
       case when (k // 7) % 10 <> 3 then case when k < 7 then 'n0' else 'n' || (k - k % 7) end
            when not exists (select 1 from part where p_partkey = k - k % 7 + 6) then 'n' || (k - k % 7 + 6) end as gene_id,
       case when (k // 7) % 10 = 3 and exists (select 1 from part where p_partkey = k - k % 7 + 6) then 'parent_cycle' end as reason
from pieces
""")
def deep_gene_models(spark, sf_dir):
    """Exons under features four to six levels down: their gene is the topmost feature, and a cycle is a reason to reject."""
    nodes = I.table(spark, sf_dir, "part").selectExpr("p_partkey as k").select(
        F.lit("region").alias("type"), F.lit(0).alias("start"), F.lit(9).alias("end"), F.lit(None).cast("int").alias("phase"),
        F.expr("'n' || cast(k as string)").alias("id"), F.expr(f"array_compact(array({_PARENT}))").alias("parents"))
    exons = I.table(spark, sf_dir, "lineitem").filter("l_partkey % 7 > 3").select(
        F.lit("exon").alias("type"), F.expr("l_linenumber * 1000").alias("start"), F.expr("l_linenumber * 1000 + 10").alias("end"),
        F.lit(None).cast("int").alias("phase"), F.lit(None).cast("string").alias("id"),
        F.array(F.expr("'n' || cast(l_partkey as string)")).alias("parents"))
    gff = nodes.unionByName(exons).select(
        F.lit("asm").alias("genome"), F.lit("chr1").alias("chrom"), "*", F.lit("+").alias("strand"), F.lit("").alias("attributes"),
        F.lit(None).cast("string").alias("name"))
    models, rejects = genes.gene_models(gff, ["genome"])
    spans = exons.groupBy(F.get("parents", F.lit(0)).alias("transcript_id")).agg(F.min("start").alias("tx_start"), F.max("end").alias("tx_end"))
    outcome = models.select("transcript_id", "gene_id", F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select("transcript_id", F.lit(None).cast("string").alias("gene_id"), "reason"))
    return outcome.join(spans, "transcript_id").select(
        "transcript_id", F.col("tx_start").cast("long").alias("tx_start"), F.col("tx_end").cast("long").alias("tx_end"), "gene_id", "reason")
