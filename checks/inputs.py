"""Genomic inputs derived from the driver tables, as DataFrames and as SQL."""

from pyspark.sql import functions as F


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- intervals and sizes ---------------------------------------------------

_CHROM = """
    (case when l_orderkey % 3 = 0 then '' else 'chr' end) ||
    (case l_partkey % 28 when 0 then 'M' when 23 then 'X' when 24 then 'Y' when 25 then 'MT'
          when 26 then 'Un_1' else cast(l_partkey % 28 as varchar(4)) end)
"""
_START = "(l_orderkey * 97 + l_partkey * 31 + l_linenumber * 7) % 150000"

INTERVALS = f"""
intervals as (
  select 'asm' as genome, chrom, span_start, span_start + span as span_end, signal
  from (select {_CHROM} as chrom, {_START} as span_start, cast(l_quantity as bigint) as span,
               cast(floor(l_extendedprice / 100) as bigint) as signal from lineitem) t)
"""

SIZES = """
sizes as (
  select case when n_nationkey = 0 then 'chrM' when n_nationkey = 23 then 'chrX'
              when n_nationkey % 4 = 1 then cast(n_nationkey as varchar(4))
              else 'chr' || cast(n_nationkey as varchar(4)) end as name,
         cast(100000 + n_nationkey * 4000 as bigint) as size
  from nation)
"""

# The contig rule step by step, independent of the spelling table the engine joins with.
HARMONISED = f"""
{INTERVALS}, {SIZES},
spelled as (
  select *, case when chrom in ('M', 'MT') then 'chrM' else 'chr' || chrom end as with_chr,
         case when chrom in ('chrM', 'chrMT') then 'MT'
              when chrom like 'chr%' then substr(chrom, 4) end as without_chr
  from intervals),
matched as (
  select *, case when chrom in (select name from sizes) then chrom
                 when with_chr in (select name from sizes) then with_chr
                 when without_chr in (select name from sizes) then without_chr end as contig
  from spelled),
harmonised as (
  select m.genome, coalesce(m.contig, m.chrom) as chrom, m.chrom as source_chrom,
         m.contig is not null as known, span_start, span_end, signal, s.size as contig_size
  from matched m left join sizes s on s.name = m.contig)
"""

CLEAN = f"""
{HARMONISED},
clean as (select * from harmonised where known and span_start < span_end and span_end <= contig_size)
"""


def intervals(spark, sf_dir):
    """(genome, chrom, start, end, value) from ``lineitem``."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("asm").alias("genome"),
        F.expr(_CHROM).alias("chrom"),
        F.expr(_START).alias("start"),
        F.col("l_quantity").cast("bigint").alias("span"),
        F.floor(F.col("l_extendedprice") / 100).cast("bigint").alias("value"),
    )
    return rows.select("genome", "chrom", "start", (F.col("start") + F.col("span")).alias("end"), "value")


def sizes(spark, sf_dir):
    """(genome, name, size) from ``nation``."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.lit("asm").alias("genome"),
        F.when(key == 0, "chrM").when(key == 23, "chrX")
        .when(key % 4 == 1, key.cast("string")).otherwise(F.concat(F.lit("chr"), key.cast("string"))).alias("name"),
        (F.lit(100000) + key * 4000).cast("bigint").alias("size"),
    )


# --- gene features ---------------------------------------------------------

_EXON_START = "cast(l_linenumber * 1000 + l_partkey % 900 as bigint)"
_EXON_END = f"{_EXON_START} + cast(l_quantity as bigint) * 3"
_STRAND = "case when (l_orderkey + (case when l_partkey % 97 = 0 then 1 else 0 end)) % 2 = 0 then '+' else '-' end"

PIECES = f"""
lines as (
  select l_orderkey, {_EXON_START} as piece_start, {_EXON_END} as piece_end, {_STRAND} as strand,
         cast(l_suppkey % 3 as integer) as phase, l_partkey, l_returnflag, l_linenumber
  from lineitem),
piece_rows as (
  select 't' || cast(l_orderkey as varchar(20)) as transcript_id, 'exon' as kind,
         'chr' || cast(l_orderkey % 22 + 1 as varchar(2)) as chrom, strand, piece_start, piece_end,
         cast(null as integer) as phase
  from lines where l_linenumber % 7 <> 6
  union all
  select 't' || cast(l_orderkey + 1 as varchar(20)), 'exon', 'chr' || cast(l_orderkey % 22 + 1 as varchar(2)),
         strand, piece_start, piece_end, cast(null as integer)
  from lines where l_linenumber % 7 <> 6 and l_partkey % 401 = 0
  union all
  select 't' || cast(l_orderkey as varchar(20)), 'CDS', 'chr' || cast(l_orderkey % 22 + 1 as varchar(2)),
         strand, piece_start + 1, piece_end, phase
  from lines where l_returnflag = 'N')
"""

NODES = """
transcripts as (
  select 't' || cast(o_orderkey as varchar(20)) || case when o_orderkey % 50 = 7 then '_lost' else '' end as transcript_id, 'mRNA' as transcript_type,
         o_orderpriority as transcript_name, 'g' || cast(o_custkey as varchar(20)) as gene_id
  from orders),
genes as (
  select 'g' || cast(c_custkey as varchar(20)) as gene_id, c_name as gene_name, c_mktsegment as gene_type
  from customer),
named as (select t.*, g.gene_name, g.gene_type from transcripts t left join genes g using (gene_id))
"""


def _gff_line(chrom, kind, start, end, strand, phase, attributes):
    return F.concat_ws(
        "\t", chrom, F.lit("src"), kind, (start + 1).cast("string"), end.cast("string"), F.lit("."), strand, phase,
        attributes,
    ).alias("value")


def gff_lines(spark, sf_dir):
    """GFF3 text of the features: customers are genes, orders transcripts, lineitems exons and CDS."""
    dot = F.lit(".")
    customer = table(spark, sf_dir, "customer").select(
        _gff_line(
            F.lit("chr1"), F.lit("gene"), F.lit(0), F.lit(9000), F.lit("+"), dot,
            F.expr("'ID=g' || c_custkey || ';Name=' || replace(c_name, '#', '%23') || ';biotype=' || c_mktsegment"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        _gff_line(
            F.expr("'chr' || (o_orderkey % 22 + 1)"), F.lit("mRNA"), F.lit(0), F.lit(9000), F.lit("+"), dot,
            F.expr(
                "'ID=t' || o_orderkey || case when o_orderkey % 50 = 7 then '_lost' else '' end || ';AdditionalSources=' || o_custkey || ';Parent=g' || o_custkey || "
                "';Name=' || replace(o_orderpriority, ' ', '%20')"
            ),
        )
    )
    start, end = F.expr(_EXON_START), F.expr(_EXON_END)
    chrom, strand = F.expr("'chr' || (l_orderkey % 22 + 1)"), F.expr(_STRAND)
    second = F.expr("case when l_partkey % 401 = 0 then ',t' || (l_orderkey + 1) else '' end")
    parent = F.expr("'Parent=t' || l_orderkey")
    lineitem = table(spark, sf_dir, "lineitem")
    kind = F.expr("case when l_linenumber % 7 = 6 then 'match_part' else 'exon' end")
    exons = lineitem.select(
        _gff_line(chrom, kind, start, end, strand, dot, F.concat(parent, second))
    )
    cds = lineitem.filter("l_returnflag = 'N'").select(
        _gff_line(chrom, F.lit("CDS"), start + 1, end, strand, F.expr("cast(l_suppkey % 3 as string)"), parent)
    )
    comments = table(spark, sf_dir, "region").select(F.concat(F.lit("##region "), F.col("r_name")).alias("value"))
    lines = comments
    for more in (customer, orders, exons, cds):
        lines = lines.unionByName(more)
    return lines.select(F.lit("asm").alias("genome"), "value")


# --- assembly reports ------------------------------------------------------

REPORT_HEADER = "# Sequence-Name\tAssigned-Molecule\tGenBank-Accn\tRefSeq-Accn\tSequence-Length\tUCSC-style-name"


# A nation's suppliers in thousands: the number of reports grows with the data, their length does not.
REPORT_GENOME = "'n' || s_nationkey || '_' || (s_suppkey div 1000)"


def report_lines(spark, sf_dir):
    """Assembly reports with suppliers as contigs; those of nation 3 have no header."""
    supplier = table(spark, sf_dir, "supplier")
    heads = supplier.filter("s_nationkey <> 3").select(
        F.expr(REPORT_GENOME).alias("genome"), F.lit(REPORT_HEADER).alias("value"), F.lit(0).alias("line")
    ).distinct()
    body = supplier.select(
        F.expr(REPORT_GENOME).alias("genome"),
        F.concat_ws(
            "\t",
            F.expr("cast(s_suppkey % 400 as string)"),
            F.expr("s_name"),
            F.expr("'CM' || s_suppkey"),
            F.expr("case when s_suppkey % 5 = 0 then 'na' else 'NC_' || s_suppkey end"),
            F.expr("case when s_suppkey % 11 = 0 then 'x' else cast(1000 + s_suppkey as string) end"),
            F.expr("case when s_nationkey % 3 = 0 or s_suppkey % 4 = 0 then 'na' else 'chr' || (s_suppkey % 400) end"),
        ).alias("value"),
        (F.col("s_suppkey") + 1).alias("line"),
    )
    lines = heads.withColumn("line", F.col("line").cast("bigint")).unionByName(body)
    return lines.select("genome", F.lit(0).cast("bigint").alias("block"), "line", "value")


def report_seqids(spark, sf_dir):
    """(genome, seqid): sequence names used by the annotation of each genome, in a style of its own."""
    supplier = table(spark, sf_dir, "supplier")
    used = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    return supplier.join(used, "s_suppkey", "left_semi").select(
        F.expr(f"case when s_nationkey % 6 = 5 then 'other' else '' end || {REPORT_GENOME}").alias("genome"),
        F.expr(
            "case s_nationkey % 4 when 0 then 'chr' || (s_suppkey % 400) when 1 then cast(s_suppkey % 400 as string) "
            "when 2 then 'NC_' || s_suppkey else 'CM' || s_suppkey end"
        ).alias("seqid"),
    )


REPORTS = """
body as (
  select 'n' || cast(s_nationkey as varchar) || '_' || cast(s_suppkey // 1000 as varchar) as genome,
         s_suppkey as line, s_nationkey,
         cast(s_suppkey % 400 as varchar(8)) as seq_name, 'CM' || cast(s_suppkey as varchar(12)) as genbank,
         case when s_suppkey % 5 = 0 then 'na' else 'NC_' || cast(s_suppkey as varchar(12)) end as refseq,
         case when s_suppkey % 11 = 0 then 'x' else cast(1000 + s_suppkey as varchar(12)) end as len,
         case when s_nationkey % 3 = 0 or s_suppkey % 4 = 0 then 'na'
              else 'chr' || cast(s_suppkey % 400 as varchar(8)) end as ucsc
  from supplier),
seqids as (
  select distinct 'n' || cast(s_nationkey as varchar) || '_' || cast(s_suppkey // 1000 as varchar) as genome,
         case s_nationkey % 4 when 0 then 'chr' || cast(s_suppkey % 400 as varchar(8))
              when 1 then cast(s_suppkey % 400 as varchar(8))
              when 2 then 'NC_' || cast(s_suppkey as varchar(12)) else 'CM' || cast(s_suppkey as varchar(12)) end as seqid
  from supplier where s_nationkey % 6 <> 5 and s_suppkey in (select l_suppkey from lineitem)),
headed as (select * from body where s_nationkey <> 3),
scores as (
  select h.genome,
         (select count(distinct b.ucsc) from headed b where b.genome = h.genome and b.ucsc <> 'na') as ucsc_names,
         (select count(distinct b.ucsc) from headed b join seqids s on s.genome = b.genome and s.seqid = b.ucsc where b.genome = h.genome and b.ucsc <> 'na') as u,
         (select count(distinct b.seq_name) from headed b join seqids s on s.genome = b.genome and s.seqid = b.seq_name where b.genome = h.genome) as n,
         (select count(distinct b.refseq) from headed b join seqids s on s.genome = b.genome and s.seqid = b.refseq where b.genome = h.genome and b.refseq <> 'na') as r,
         (select count(distinct b.genbank) from headed b join seqids s on s.genome = b.genome and s.seqid = b.genbank where b.genome = h.genome) as g,
         (select count(*) from seqids s where s.genome = h.genome) as annotated
  from (select distinct genome from headed) h),
choice as (
  select genome, case when ucsc_names > 0 and (annotated = 0 or u >= greatest(u, n, r, g)) then 'ucsc-style-name'
                      when n >= greatest(u, r, g) then 'sequence-name'
                      when u >= greatest(r, g) then 'ucsc-style-name'
                      when r >= g then 'refseq-accn' else 'genbank-accn' end as chosen
  from scores)
"""


# --- tracks ----------------------------------------------------------------

_TYPE = (
    "case event_type when 'click' then 'bigwig' when 'view' then 'bigbed' when 'purchase' then 'bed' "
    "when 'error' then 'gff3' else event_type end"
)
_HUB = "case when user_id % 3 = 0 then null when user_id % 3 = 1 then '' else 'hub' || cast(user_id % 7 as varchar(4)) end"
_GENOME = "'g' || cast(user_id % 5 as varchar(4))"
_PATH = "'/data/' || cast(user_id as varchar(12)) || '_tool' || cast(event_id % 9 as varchar(2)) || '.sorted.' || event_type || '-' || cast(event_id as varchar(12)) || '.bb'"

TRACKS = f"""
sheet as (
  select cast(event_id as varchar(12)) as run, {_TYPE} as file_type, {_PATH} as path, {_GENOME} as genome, {_HUB} as hub
  from events)
"""


def samplesheet(spark, sf_dir):
    """Samplesheet rows from ``events``, under the column names of the file."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("Run"),
        F.expr(_TYPE).alias("FileType"),
        F.expr(_PATH).alias("Path"),
        F.expr(_GENOME).alias("Genome"),
        F.expr(_HUB).alias("Hub"),
    )
