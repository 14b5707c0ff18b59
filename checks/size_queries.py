"""Chromosome sizes: assembly reports, sequences, and the choice between sources."""

from pyspark.sql import functions as F

from trackspark.functions import names as N
from trackspark.functions import values as V
from trackspark.operators import sizes as SZ
from trackspark.operators.dedupe import dedupe
from trackspark.sources.fasta import sequence_lengths
from trackspark.sources.tables import parse_assembly_report

from . import inputs as I
from .registry import query


def _report(spark, sf_dir):
    return parse_assembly_report(I.report_lines(spark, sf_dir), keys=("genome",))


@query("report_name_scores", f"""
with {I.REPORTS},
long as (
  select genome, 0 as rank, nullif(ucsc, 'na') as name from headed
  union all select genome, 1, seq_name from headed
  union all select genome, 2, nullif(refseq, 'na') from headed
  union all select genome, 3, genbank from headed)
select l.genome, l.rank, count(distinct l.name) as names, count(distinct s.seqid) as score
from long l left join seqids s on s.genome = l.genome and s.seqid = l.name group by l.genome, l.rank
""")
def report_name_scores(spark, sf_dir):
    return SZ.name_scores(_report(spark, sf_dir), I.report_seqids(spark, sf_dir))


@query("report_name_column", f"with {I.REPORTS} select genome, chosen from choice")
def report_name_column(spark, sf_dir):
    return SZ.choose_name_column(_report(spark, sf_dir), I.report_seqids(spark, sf_dir))


@query("report_chrom_sizes", f"""
with {I.REPORTS},
picked as (
  select b.genome, b.line, c.chosen, b.len,
         case c.chosen when 'ucsc-style-name' then coalesce(nullif(b.ucsc, 'na'), b.seq_name)
                       when 'refseq-accn' then coalesce(nullif(b.refseq, 'na'), b.seq_name)
                       when 'genbank-accn' then b.genbank else b.seq_name end as raw
  from body b left join choice c on c.genome = b.genome),
named as (
  select genome, line, cast(len as bigint) as size,
         case when chosen = 'ucsc-style-name' then raw when regexp_full_match(raw, '[0-9]+') then 'chr' || raw
              else raw end as name
  from picked where regexp_full_match(len, '[0-9]+'))
select genome, name, arg_min(size, line) as size from named group by genome, name
""")
def report_chrom_sizes(spark, sf_dir):
    return SZ.chrom_sizes_from_reports(_report(spark, sf_dir), I.report_seqids(spark, sf_dir))


@query("fasta_lengths", """
select 'c' || cast(conv_id as varchar) as name,
       cast(sum(length(replace(replace(replace(replace(text, ' ', ''), chr(9), ''), chr(10), ''), chr(13), '')))
            as bigint) as size
from conversations group by conv_id
""")
def fasta_lengths(spark, sf_dir):
    turns = I.table(spark, sf_dir, "conversations")
    path = F.concat(F.lit("f"), F.col("conv_id") % 64, F.lit(".fa")).alias("path")
    heads = turns.select("conv_id").distinct().select(
        path, (F.col("conv_id") * 100000).alias("line"),
        F.concat(F.lit(">c"), F.col("conv_id").cast("string"), F.lit(" talk > chat")).alias("value"),
    )
    sequences = turns.select(
        path, (F.col("conv_id") * 100000 + F.col("turn") + 1).alias("line"), F.concat(F.lit(" "), F.col("text")).alias("value")
    )
    lines = heads.unionByName(sequences).select(
        "path", F.lit(0).cast("bigint").alias("block"), "line", "value"
    )
    return sequence_lengths(lines).select("name", "size")


@query("sizes_source_pick", """
select s_nationkey as genome, source, path from (
  select s_nationkey, case s_suppkey % 3 when 0 then 'fasta' when 1 then 'ucsc' else 'report' end as source,
         s_name as path,
         row_number() over (partition by s_nationkey
                            order by case s_suppkey % 3 when 0 then 3 when 1 then 2 else 1 end, s_name) as place
  from supplier) t where place = 1
""")
def sizes_source_pick(spark, sf_dir):
    rows = I.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("genome"),
        F.expr("case s_suppkey % 3 when 0 then 'fasta' when 1 then 'ucsc' else 'report' end").alias("source"),
        F.col("s_name").alias("path"),
    )
    return SZ.pick_sizes_source(rows)


_GENOME = "case s_suppkey % 3 when 0 then 'GCA_' when 1 then 'GCF_' else 'hg' end || cast(s_suppkey as varchar(12))"
_REPORT = "case when s_suppkey % 4 = 0 then '/reports/' || s_name when s_suppkey % 4 = 1 then '' end"


@query("sizes_source_split", f"""
with g as (select {_GENOME} as genome, coalesce({_REPORT}, '') as report from supplier)
select genome, report, 'report' as source from g where report <> ''
union all
select genome, '', 'name' from g where report = '' and not starts_with(genome, 'GCA_') and not starts_with(genome, 'GCF_')
""")
def sizes_source_split(spark, sf_dir):
    genomes = I.table(spark, sf_dir, "supplier").select(
        F.expr(_GENOME).alias("genome"), F.expr(_REPORT).alias("assembly_report")
    )
    with_report, by_name = SZ.split_size_sources(genomes)
    return with_report.select("genome", F.col("assembly_report").alias("report"), F.lit("report").alias("source")).unionByName(
        by_name.select("genome", F.lit("").alias("report"), F.lit("name").alias("source"))
    )


@query("representative_gff", f"""
with {I.TRACKS}
select genome, coalesce(min(path) filter (where file_type = 'gff3' and path <> ''), '') as path from sheet group by genome
""")
def representative_gff(spark, sf_dir):
    from trackspark.sources.tables import samplesheet_rows

    return SZ.representative_gff(samplesheet_rows(I.samplesheet(spark, sf_dir)))


@query("dedupe_first_and_last", """
select user_id, arg_min(event_type, event_id) as first_type, arg_max(event_type, event_id) as last_type
from events group by user_id
""")
def dedupe_first_and_last(spark, sf_dir):
    rows = I.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    first = dedupe(rows, ["user_id"], keep="first", order="event_id")
    last = dedupe(rows, ["user_id"], keep="last", order="event_id")
    return first.select("user_id", F.col("event_type").alias("first_type")).join(
        last.select("user_id", F.col("event_type").alias("last_type")), "user_id"
    )


@query("dedupe_distinct_pairs", "select distinct user_id, event_type from events")
def dedupe_distinct_pairs(spark, sf_dir):
    return dedupe(I.table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("chrize_names", """
select l_partkey, l_linenumber, count(*) as records,
       case when l_partkey % 5 = 0 then 'chr' || cast(l_partkey as varchar) when l_partkey % 5 = 1 then 'chrX'
            when l_partkey % 5 = 2 then 'chrM' when l_partkey % 5 = 3 then 'chrM'
            else 'Y' || cast(l_linenumber as varchar) end as name
from lineitem group by l_partkey, l_linenumber
""")
def chrize_names(spark, sf_dir):
    raw = F.expr(
        "case l_partkey % 5 when 0 then cast(l_partkey as string) when 1 then 'X' when 2 then 'M' when 3 then 'MT' "
        "else 'Y' || l_linenumber end"
    )
    return I.table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber", N.chrize(raw).alias("name")).agg(
        F.count("*").alias("records")
    )


@query("header_keys", """
select distinct lower(replace(replace(p_name || '_' || p_brand, ' ', '-'), '_', '-')) as label from part
""")
def header_keys(spark, sf_dir):
    return I.table(spark, sf_dir, "part").select(
        N.header_key(F.expr("'  ' || p_name || '_' || p_brand || '\t '")).alias("label")
    ).distinct()


@query("integer_parse", """
select l_orderkey % 100 as bucket, count(*) filter (where l_linenumber % 3 <> 0) as parsed,
       cast(sum(case when l_linenumber % 3 <> 0 then l_partkey end) as bigint) as total
from lineitem group by 1
""")
def integer_parse(spark, sf_dir):
    text = F.expr("case l_linenumber % 3 when 0 then l_partkey || '.5' when 1 then ' ' || l_partkey else cast(l_partkey as string) end")
    parsed = V.number(text)
    return I.table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 100).alias("bucket")).agg(
        F.count(parsed).alias("parsed"), F.sum(parsed).alias("total")
    )
