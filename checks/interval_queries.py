"""Interval, signal and contig queries over ``lineitem`` and ``nation``."""

from pyspark.sql import functions as F

from trackspark.operators import contigs, intervals, signal
from trackspark.plans.jobs import clean_intervals, clean_signal
from trackspark.sources import records

from . import inputs as I
from .registry import query

REDUCTIONS = [1000, 4000, 16000]


def _clean(spark, sf_dir):
    return clean_signal(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean


@query("clean_intervals_by_contig", f"""
with {I.HARMONISED}
select chrom, count(*) as records, cast(sum(span_end - span_start) as bigint) as bases,
       min(span_start) as first_start, max(span_end) as last_end
from harmonised where known and span_start <= span_end and span_end <= contig_size group by chrom
""")
def clean_intervals_by_contig(spark, sf_dir):
    clean = clean_intervals(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean
    return clean.groupBy("chrom").agg(
        F.count("*").alias("records"),
        F.sum(F.col("end") - F.col("start")).alias("bases"),
        F.min("start").alias("first_start"),
        F.max("end").alias("last_end"),
    )


@query("contig_harmonise", f"""
with {I.HARMONISED}
select source_chrom, chrom, contig_size, count(*) as records from harmonised
group by source_chrom, chrom, contig_size
""")
def contig_harmonise(spark, sf_dir):
    rows = I.intervals(spark, sf_dir).withColumn("source_chrom", F.col("chrom"))
    harmonised = contigs.harmonise_contigs(rows, I.sizes(spark, sf_dir))
    return harmonised.groupBy("source_chrom", "chrom", "contig_size").agg(F.count("*").alias("records"))


@query("contig_harmonise_by_genome", f"""
with {I.INTERVALS},
rows as (select 'a' || cast(span_start % 5 as varchar(2)) as assembly, chrom, signal from intervals),
names as (
  select 'a' || cast(n_regionkey as varchar(2)) as assembly, case when n_nationkey % 2 = 0 then 'chr' else '' end ||
         case n_nationkey when 0 then 'M' when 1 then 'MT' when 2 then 'MT' when 3 then 'M'
              else cast(n_nationkey as varchar(4)) end as name
  from nation),
spelled as (
  select *, case when chrom in ('M', 'MT') then 'chrM' else 'chr' || chrom end as with_chr,
         case when chrom in ('chrM', 'chrMT') then 'MT' when chrom like 'chr%' then substr(chrom, 4) end as without_chr
  from rows),
matched as (
  select s.assembly, s.chrom as source_chrom, signal, coalesce(a.name, b.name, c.name) as contig
  from spelled s
  left join names a on a.assembly = s.assembly and a.name = s.chrom
  left join names b on b.assembly = s.assembly and b.name = s.with_chr
  left join names c on c.assembly = s.assembly and c.name = s.without_chr)
select assembly, source_chrom, coalesce(contig, source_chrom) as chrom, contig is not null as known,
       count(*) as records, cast(sum(signal) as bigint) as signal
from matched group by all
""")
def contig_harmonise_by_genome(spark, sf_dir):
    rows = I.intervals(spark, sf_dir).select(
        F.expr("'a' || (start % 5)").alias("assembly"), "chrom", F.col("chrom").alias("source_chrom"), "value"
    )
    sizes = I.table(spark, sf_dir, "nation").select(
        F.expr("'a' || n_regionkey").alias("assembly"),
        F.expr(
            "case when n_nationkey % 2 = 0 then 'chr' else '' end || case n_nationkey when 0 then 'M' when 1 then 'MT' "
            "when 2 then 'MT' when 3 then 'M' else cast(n_nationkey as string) end"
        ).alias("name"),
        F.lit(1).cast("bigint").alias("size"),
    )
    harmonised = contigs.harmonise_contigs(rows, sizes, on="assembly")
    return harmonised.groupBy("assembly", "source_chrom", "chrom", "known").agg(
        F.count("*").alias("records"), F.sum("value").alias("signal")
    )


@query("contig_drop_missing", f"""
with {I.HARMONISED}
select chrom, span_start as start_pos, span_end as end_pos, signal from harmonised where known
""")
def contig_drop_missing(spark, sf_dir):
    kept = contigs.drop_missing_contigs(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir))
    return kept.select(
        "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("value").alias("signal")
    )


@query("contig_missing_audit", f"""
with {I.HARMONISED}
select genome, chrom, count(*) as records from harmonised where not known group by genome, chrom
""")
def contig_missing_audit(spark, sf_dir):
    return contigs.missing_contigs(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir))


@query("contig_first_missing", f"""
with {I.HARMONISED}
select genome, chrom, count(*) as records from harmonised where not known group by genome, chrom
order by genome, chrom limit 5
""")
def contig_first_missing(spark, sf_dir):
    harmonised = contigs.harmonise_contigs(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir))
    return contigs.first_missing(harmonised, shown=5)


@query("bounds_check", f"""
with {I.HARMONISED}
select chrom, case when span_end > contig_size then 'end_past_contig' else 'ok' end as outcome, count(*) as records
from harmonised where known group by 1, 2
""")
def bounds_check(spark, sf_dir):
    known = contigs.drop_missing_contigs(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir))
    tagged = intervals.check_bounds(known)
    return tagged.groupBy("chrom", F.coalesce("reject_reason", F.lit("ok")).alias("outcome")).agg(
        F.count("*").alias("records")
    )


@query("interval_sort", f"""
with {I.CLEAN}
select chrom, span_start as start_pos, span_end as end_pos, signal from clean
""")
def interval_sort(spark, sf_dir):
    return intervals.sort_intervals(_clean(spark, sf_dir)).select(
        "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("value").alias("signal")
    )


@query("signal_overlaps", f"""
with {I.HARMONISED},
ordered as (
  select *, max(span_end) over (partition by chrom order by span_start, span_end, signal
                                rows between unbounded preceding and 1 preceding) as reach
  from harmonised where known)
select chrom, span_start as start_pos, span_end as end_pos, signal, count(*) as copies
from ordered where reach > span_start group by 1, 2, 3, 4
""")
def signal_overlaps(spark, sf_dir):
    known = contigs.drop_missing_contigs(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir))
    found = intervals.find_overlaps(known.drop("contig_size"), keys=("genome", "chrom"))
    return found.select(
        "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("value").alias("signal"),
        "copies",
    )


DEPTH = f"""
{I.CLEAN},
steps as (
  select chrom, pos, sum(step) as step from (
    select chrom, span_start as pos, 1 as step from clean
    union all select chrom, span_end, -1 from clean) e
  group by chrom, pos having sum(step) <> 0),
runs as (
  select chrom, pos as run_start, lead(pos) over w as run_end,
         cast(sum(step) over (partition by chrom order by pos rows unbounded preceding) as bigint) as depth
  from steps window w as (partition by chrom order by pos)),
depth_runs as (select * from runs where depth > 0)
"""


@query("coverage_depth", f"""
with {DEPTH} select chrom, run_start, run_end, depth from depth_runs
""")
def coverage_depth(spark, sf_dir):
    runs = intervals.coverage_depth(_clean(spark, sf_dir), keys=("genome", "chrom"))
    return runs.select("chrom", F.col("start").alias("run_start"), F.col("end").alias("run_end"), "depth")


def _bins(source, start, end, value):
    return " union all ".join(
        f"""
        select {width} as reduction, chrom, bin, cast(sum(bases) as bigint) as covered,
               cast(sum(v * bases) as bigint) as total, cast(sum(v * v * bases) as bigint) as total_sq,
               min(v) as low, max(v) as high
        from (select chrom, bin, {value} as v,
                     least({end}, (bin + 1) * {width}) - greatest({start}, bin * {width}) as bases
              from (select *, unnest(generate_series({start} // {width}, ({end} - 1) // {width})) as bin
                    from {source}) b) c
        group by chrom, bin"""
        for width in REDUCTIONS
    )


@query("signal_summary", f"with {I.CLEAN} {_bins('clean', 'span_start', 'span_end', 'signal')}")
def signal_summary(spark, sf_dir):
    return signal.summarise_signal(_clean(spark, sf_dir), REDUCTIONS, keys=("genome", "chrom")).drop("genome")


@query("coverage_summary", f"with {DEPTH} {_bins('depth_runs', 'run_start', 'run_end', 'depth')}")
def coverage_summary(spark, sf_dir):
    return intervals.summarise_coverage(_clean(spark, sf_dir), REDUCTIONS, keys=("genome", "chrom")).drop("genome")


@query("bed_text_scan", f"""
with {I.INTERVALS}
select chrom, span_start as start_pos, span_end as end_pos, 'r' || cast(signal as varchar(12)) as name,
       cast(signal % 1000 as integer) as score, case when signal % 2 = 0 then '+' else '-' end as strand,
       count(*) as records
from intervals group by 1, 2, 3, 4, 5, 6
""")
def bed_text_scan(spark, sf_dir):
    lines = I.intervals(spark, sf_dir).select(
        F.concat(
            F.lit(" \t"), F.col("chrom"), F.lit("  \t"), F.col("start").cast("string"), F.lit("\t"),
            F.col("end").cast("string"), F.lit(" "), F.concat(F.lit("r"), F.col("value").cast("string")), F.lit("\t"),
            (F.col("value") % 1000).cast("string"), F.lit("\t"),
            F.when(F.col("value") % 2 == 0, "+").otherwise("-"), F.lit("\t "),
        ).alias("value")
    )
    return (
        records.typed_bed(records.parse_bed(lines))
        .groupBy("chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "name", "score", "strand")
        .agg(F.count("*").alias("records"))
    )


@query("bedgraph_text_scan", f"""
with {I.INTERVALS}
select chrom, span_start as start_pos, span_end as end_pos, signal from intervals where signal % 10 <> 3
""")
def bedgraph_text_scan(spark, sf_dir):
    record = F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"),
                         F.col("value").cast("string"))
    header = F.concat(F.element_at(F.array(F.lit("track "), F.lit("browser "), F.lit("#")),
                                   (F.col("start") % 3 + 1).cast("int")), record)
    lines = I.intervals(spark, sf_dir).select(
        F.when(F.col("value") % 10 == 3, header).otherwise(record).alias("value")
    )
    return records.parse_bedgraph(lines).select(
        "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"),
        F.col("value").cast("bigint").alias("signal"),
    )
