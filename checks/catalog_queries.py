"""Samplesheet routing, names, metadata, display parameters and hubs."""

from pyspark.sql import functions as F

from trackspark.functions import names as N
from trackspark.functions import values as V
from trackspark.operators import catalog as C
from trackspark.plans.jobs import catalog_job
from trackspark.sources.logs import summarise_lines
from trackspark.sources.tables import metadata_rows, metadata_warnings, samplesheet_rows

from . import inputs as I
from .registry import query


def _sheet(spark, sf_dir):
    return samplesheet_rows(I.samplesheet(spark, sf_dir))


@query("samplesheet_route", f"""
with {I.TRACKS}
select case when file_type in ('bed', 'bedgraph', 'bigbed', 'bigwig', 'gff3') then file_type else 'unknown' end as route,
       genome, count(*) as files from sheet group by 1, 2
""")
def samplesheet_route(spark, sf_dir):
    routed = C.route_by_type(_sheet(spark, sf_dir))
    return C.track_counts(
        C.union_tracks(*[rows.withColumn("route", F.lit(kind)) for kind, rows in routed.items()]), "route", "genome"
    ).withColumnRenamed("tracks", "files")


HUBS = f"""
{I.TRACKS},
tracks as (
  select *, file_type as track_type, coalesce(nullif(hub, ''), 'lab_' || genome) as hub_key
  from sheet where file_type in ('bigwig', 'bigbed'))
"""


def _tracks(spark, sf_dir):
    """The already converted files of the samplesheet, as catalog rows."""
    sheet = _sheet(spark, sf_dir).filter(F.col("file_type").isin("bigwig", "bigbed"))
    return C.with_hub_key(sheet.withColumnRenamed("file_type", "track_type"), "lab")


@query("hub_keys", f"with {HUBS} select run, hub_key as hub, genome from tracks")
def hub_keys(spark, sf_dir):
    return _tracks(spark, sf_dir).select("run", "hub", "genome")


@query("hub_groups", f"""
with {HUBS}
select hub_key as hub, genome, track_type, path, count(*) as tracks
from tracks where track_type in ('bigbed', 'bigwig') group by all
""")
def hub_groups(spark, sf_dir):
    return C.group_hubs(_tracks(spark, sf_dir))


@query("sample_groups", f"""
with {HUBS}
select split_part(split_part(path, '/', 3), '_', 1) as sample_id, path, count(*) as tracks from tracks group by all
""")
def sample_groups(spark, sf_dir):
    return C.group_tracks(C.with_track_fields(_tracks(spark, sf_dir)), "sample_id")


@query("annotation_groups", f"""
with {HUBS}
select 'tool' || substr(path, strpos(path, '_tool') + 5, 1) as annotation_type, path, count(*) as tracks
from tracks where track_type = 'bigbed' group by all
""")
def annotation_groups(spark, sf_dir):
    return C.group_tracks(C.with_track_fields(_tracks(spark, sf_dir)), "annotation_type")


@query("track_counts", f"with {HUBS} select track_type, genome, count(*) as tracks from tracks group by 1, 2")
def track_counts(spark, sf_dir):
    return C.track_counts(_tracks(spark, sf_dir), "track_type", "genome")


@query("genome_sizes_attached", f"""
with {I.TRACKS},
sizes as (select 'g' || cast(s_nationkey % 5 as varchar(4)) as genome, s_suppkey + 1 as size from supplier)
select run, s.genome, contigs, cast(total as bigint) as assembly_size from sheet
join (select genome, count(*) as contigs, sum(size) as total from sizes group by genome) s using (genome)
where file_type = 'bed'
""")
def genome_sizes_attached(spark, sf_dir):
    sizes = I.table(spark, sf_dir, "supplier").select(
        F.expr("'g' || (s_nationkey % 5)").alias("genome"), (F.col("s_suppkey") + 1).alias("size")
    )
    files = _sheet(spark, sf_dir).filter("file_type = 'bed'")
    return C.attach_sizes(files, sizes).select("run", "genome", "contigs", "assembly_size")


_FILE = "replace(p_name || '.Sorted.' || replace(p_brand, '#', '-') || '_final.' || case p_partkey % 8 when 0 then 'bw' when 1 then 'bb' when 2 then 'bedgraph' when 3 then 'bg' when 4 then 'bed' when 5 then 'bigwig' when 6 then 'gff3' else 'txt' end, ' ', '.')"


@query("file_names", f"""
with f as (select p_partkey, {_FILE} as filename from part),
s as (select *, regexp_replace(filename, '[.][^.]*$', '') as stem from f)
select p_partkey, filename, stem,
       regexp_replace(replace(replace(stem, '.', '_'), '-', '_'), '[^a-zA-Z0-9_]', '', 'g') as clean,
       trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(stem, '[.]sorted', '', 'gi'), '_final', '', 'gi'),
            '.', ' '), '_', ' '), ' +', ' ', 'g')) as label,
       case p_partkey % 8 when 0 then 'bigwig' when 1 then 'bigbed' when 2 then 'bedgraph' when 3 then 'bedgraph'
            when 4 then 'bed' when 5 then 'bigwig' when 6 then 'gff3' else 'unknown' end as file_type,
       stem as run
from s
""")
def file_names(spark, sf_dir):
    path = F.expr(f"'/data/x.y/' || {_FILE}")
    rows = I.table(spark, sf_dir, "part").select("p_partkey", N.basename(path).alias("filename"))
    rows = rows.withColumn("stem", N.without_extension("filename"))
    return rows.select(
        "p_partkey", "filename", "stem", N.sanitise("stem").alias("clean"), N.readable_label("stem").alias("label"),
        N.file_type("filename").alias("file_type"),
        N.run_name(F.concat(F.lit("ncORFs_"), F.col("filename"))).alias("run"),
    )


@query("pattern_ids", f"""
with f as (select p_partkey, p_name, p_brand, {_FILE} as filename from part)
select p_partkey, case when p_brand like 'Brand#1%' then 'Brand-' || substr(p_brand, 7)
                       else split_part(p_name, ' ', 1) end as sample_id,
       case when p_brand like 'Brand#1%' then substr(p_brand, 7) else split_part(p_name, ' ', 2) end as annotation_type
from f
""")
def pattern_ids(spark, sf_dir):
    files = I.table(spark, sf_dir, "part").select(
        "p_partkey", F.expr(f"'/data/' || {_FILE}").alias("path"), F.lit("BigBed").alias("track_type")
    )
    tracks = C.with_track_fields(
        files, r"[.](?P<sample_id>Brand-(1\d*))_", r"Brand-(?P<annotation_type>(?P<first>1)\d*)_"
    )
    return tracks.select("p_partkey", "sample_id", "annotation_type")


def metadata_sheet(spark, sf_dir):
    return I.table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 120).cast("string").alias("sample_id"),
        F.col("c_name").alias("short_label"),
        F.expr("case when c_custkey % 4 = 0 then '' else c_mktsegment end").alias("long_label"),
        F.expr("case when c_custkey % 3 = 0 then '' else c_custkey || ',0,0' end").alias("color"),
        F.expr("case when c_custkey % 5 = 0 then null else 'dense' end").alias("visibility"),
        F.expr("case when c_custkey % 2 = 0 then '' else cast(c_custkey % 9 as string) end").alias("priority"),
        F.expr(
            "case c_custkey % 3 when 0 then '{\"autoScale\":\"off\",\"height\":' || c_custkey || '}' "
            "when 1 then '{bad' else '' end"
        ).alias("additional_params"),
        F.col("c_custkey").alias("row_order"),
    )


def _metadata(spark, sf_dir):
    return metadata_rows(metadata_sheet(spark, sf_dir))


METADATA = """
metadata as (
  select cast(c_custkey % 120 as varchar) as sample_id, arg_max(c_custkey, c_custkey) as k from customer
  group by c_custkey % 120),
sheet_rows as (
  select m.sample_id, m.k, c_name as short_label, case when k % 4 = 0 then '' else c_mktsegment end as long_label,
         case when k % 3 = 0 then '' else k || ',0,0' end as color,
         case when k % 5 = 0 then '' else 'dense' end as visibility,
         case when k % 2 = 0 then '' else cast(k % 9 as varchar) end as priority
  from metadata m join customer c on c.c_custkey = m.k)
"""


@query("sample_metadata", f"with {METADATA} select sample_id, short_label, long_label, color, visibility, priority, case when k % 3 = 0 then cast(k as varchar) end as height from sheet_rows")
def sample_metadata(spark, sf_dir):
    return _metadata(spark, sf_dir).select(
        "sample_id", "short_label", "long_label", "color", "visibility", "priority",
        F.col("additional_params")["height"].alias("height"),
    )


@query("sample_metadata_warnings", """
select cast(c_custkey % 120 as varchar) as sample_id, '{bad' as additional_params, c_custkey as row_order
from customer where c_custkey % 3 = 1
""")
def sample_metadata_warnings(spark, sf_dir):
    return metadata_warnings(metadata_sheet(spark, sf_dir))


@query("track_metadata", f"""
with {HUBS}, {METADATA},
named as (
  select run, split_part(split_part(path, '/', 3), '_', 1) as sample_id,
         trim(replace(replace(replace(regexp_replace(split_part(path, '/', 3), '[.][^.]*$', ''), '.sorted', ''), '.', ' '), '_', ' ')) as label
  from tracks)
select n.run, n.sample_id, m.sample_id is not null as matched, coalesce(m.short_label, n.label) as short_label,
       coalesce(m.long_label, n.label) as long_label, coalesce(m.color, '') as color,
       coalesce(m.visibility, '') as visibility, coalesce(nullif(m.priority, ''), '1') as priority,
       case when m.k % 3 = 0 then cast(m.k as varchar) end as height
from named n left join sheet_rows m using (sample_id)
""")
def track_metadata(spark, sf_dir):
    tracks = C.apply_sample_metadata(C.with_track_fields(_tracks(spark, sf_dir)), _metadata(spark, sf_dir))
    return tracks.select(
        "run", "sample_id", F.col("has_metadata").alias("matched"), "short_label", "long_label", "color", "visibility",
        "priority", F.col("additional_params")["height"].alias("height"),
    )


def _params_sql(ensembl):
    parent = "cast(null as varchar)" if ensembl else "'composite_all_' || track_type"
    shown = "case track_type when 'bigwig' then 'bigWig' else 'bigBed' end"
    return f"""
with {HUBS}, {METADATA},
named as (
  select *, split_part(split_part(path, '/', 3), '_', 1) as sample_id,
         regexp_replace(split_part(path, '/', 3), '[.][^.]*$', '') as stem from tracks),
labelled as (
  select *, replace(replace(stem, '.', '_'), '-', '_') as basename,
         trim(replace(replace(replace(stem, '.sorted', ''), '.', ' '), '_', ' ')) as label from named)
select run, hub_key as hub, replace(replace(hub_key, ' ', '_'), '-', '_') || '_' || basename as name,
       coalesce(nullif(m.visibility, ''), case track_type when 'bigwig' then 'full' else 'pack' end) as visibility,
       {shown} as tracktype, substr(coalesce(m.short_label, label), 1, 17) as short_label,
       substr(hub_key || ' - ' || coalesce(m.long_label, label), 1, 76) as long_label,
       coalesce(nullif(m.color, ''), case track_type when 'bigwig' then '0,0,100' else '0,100,0' end) as color,
       coalesce(nullif(m.priority, ''), '1') as priority,
       case when m.k % 3 = 0 then 'off' when track_type = 'bigwig' then 'on' end as auto_scale,
       case when track_type = 'bigwig' then 'on' end as always_zero,
       {shown if ensembl else "cast(null as varchar)"} as format,
       {parent} as composite
from labelled l left join sheet_rows m using (sample_id)
"""


def _params(spark, sf_dir, ensembl):
    rows = _sheet(spark, sf_dir).filter(F.col("file_type").isin("bigwig", "bigbed"))
    catalog = catalog_job(
        rows.withColumnRenamed("file_type", "track_type"), "lab", _metadata(spark, sf_dir), ensembl=ensembl
    )
    params = F.col("params")
    return catalog.select(
        "run", "hub", params["name"].alias("name"), params["visibility"].alias("visibility"),
        params["tracktype"].alias("tracktype"), params["short_label"].alias("short_label"),
        params["long_label"].alias("long_label"), params["color"].alias("color"), params["priority"].alias("priority"),
        params["autoScale"].alias("auto_scale"), params["alwaysZero"].alias("always_zero"),
        params["format"].alias("format"), "composite",
    )


@query("track_display_params", _params_sql(False))
def track_display_params(spark, sf_dir):
    return _params(spark, sf_dir, False)


@query("track_display_params_ensembl", _params_sql(True))
def track_display_params_ensembl(spark, sf_dir):
    return _params(spark, sf_dir, True)


@query("duplicate_track_names", f"""
with {HUBS}
select hub_key as hub, genome, 'u' || cast(cast(run as bigint) % 50 as varchar) as name, count(*) as tracks
from tracks group by all having count(*) > 1
""")
def duplicate_track_names(spark, sf_dir):
    name = F.concat(F.lit("u"), (F.col("run").cast("bigint") % 50).cast("string"))
    return C.duplicate_names(_tracks(spark, sf_dir).withColumn("params", F.create_map(F.lit("name"), name)))


@query("multi_assembly_entries", f"""
with {HUBS} select distinct genome, path from tracks
""")
def multi_assembly_entries(spark, sf_dir):
    tracks = _tracks(spark, sf_dir)
    bigbeds, bigwigs = tracks.filter("track_type = 'bigbed'"), tracks.filter("track_type = 'bigwig'")
    return C.multi_assembly(bigbeds, bigwigs.drop("assembly_report"), tracks)


@query("ensembl_genomes", """
select s_suppkey, case when s_suppkey % 3 = 0 then 'GRCh38.p' || cast(s_suppkey as varchar)
                       when s_suppkey % 3 = 1 then 'hg18' else 'mm10-hg38' end as genome
from supplier
""")
def ensembl_genomes(spark, sf_dir):
    raw = F.expr("case s_suppkey % 3 when 0 then 'hg38.p' || s_suppkey when 1 then 'hg18' else 'mm10-hg38' end")
    return I.table(spark, sf_dir, "supplier").select("s_suppkey", N.ensembl_genome(raw).alias("genome"))


@query("json_params_merge", """
select event_id, json_extract_string(props, '$.k') as base_k,
       case when event_id % 2 = 0 then 'x' else json_extract_string(props, '$.k') end as merged_k,
       case when event_id % 2 = 0 then 3 else 2 end as keys
from events
""")
def json_params_merge(spark, sf_dir):
    base = V.merge_maps(V.json_map("props"), F.create_map(F.lit("event"), F.col("event_id").cast("string")))
    override = V.json_map(F.expr("case when event_id % 2 = 0 then '{\"k\":\"x\",\"z\":[1]}' else '{oops' end"))
    merged = V.merge_maps(base, override)
    return I.table(spark, sf_dir, "events").select(
        "event_id", V.json_map("props")["k"].alias("base_k"), merged["k"].alias("merged_k"), F.size(merged).alias("keys")
    )


@query("json_params_repeated", """
select event_id, cast(event_id % 5 as varchar) as k, cast(event_id % 7 as varchar) as n, 2 as keys from events
""")
def json_params_repeated(spark, sf_dir):
    text = F.expr("""concat('{"k":"a","n":', event_id, ',"k":"', event_id % 5, '","n":', event_id % 7, '}')""")
    merged = V.merge_maps(F.create_map(F.lit("k"), F.lit("base")), V.json_map(text))
    return I.table(spark, sf_dir, "events").select(
        "event_id", merged["k"].alias("k"), merged["n"].alias("n"), F.size(merged).alias("keys")
    )


@query("log_summary", """
select count(distinct source) as files, cast(sum(len(string_split(text, chr(10)))) as bigint) as lines from documents
""")
def log_summary(spark, sf_dir):
    lines = I.table(spark, sf_dir, "documents").select(
        F.col("source").alias("path"), F.explode(F.split("text", "\n")).alias("value")
    )
    return summarise_lines(lines)
