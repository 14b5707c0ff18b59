"""Files written to the shared scratch folder and read back: sinks, sources and whole jobs over files."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from trackspark.functions import values as V
from trackspark.operators import catalog, intervals
from trackspark.operators.lookup import row_bytes
from trackspark.operators.ranges import clustered_by_bytes
from trackspark.operators.scratch import folders_unsorted, land, scratch_dir
from trackspark.plans import jobs
from trackspark.sinks import regions, zoom
from trackspark.sinks import tracks as sinks
from trackspark.sources import fasta, records, tables
from trackspark.sources.text import literal_path

from . import inputs as I
from .catalog_queries import HUBS, METADATA, metadata_sheet
from .gene_queries import ASSEMBLED, KEYS
from .interval_queries import _bins
from .registry import query


def _folder(spark):
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/query-{uuid.uuid4().hex}"


@query("interval_sink", f"""
with {I.CLEAN}
select genome, chrom, count(*) as records, min(span_start) as first_start, max(span_end) as last_end,
       cast(sum(signal) as bigint) as signal
from clean group by genome, chrom
""")
def interval_sink(spark, sf_dir):
    path = _folder(spark)
    clean = jobs.clean_signal(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean
    sinks.write_intervals(clean, path)
    return spark.read.parquet(path).groupBy("genome", "chrom").agg(
        F.count("*").alias("records"), F.min("start").alias("first_start"), F.max("end").alias("last_end"),
        F.sum("value").alias("signal"),
    )


@query("interval_sink_order", f"""
with {I.CLEAN}
select genome, count(*) as records, cast(0 as bigint) as out_of_order, cast(0 as bigint) as overlapping_files
from clean group by genome
""")
def interval_sink_order(spark, sf_dir):
    """Records that come before their predecessor in a file, and files that reach into one another."""
    path = _folder(spark)
    clean = jobs.clean_signal(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean
    sinks.write_intervals(clean, path)
    key = F.struct("chrom", "start", "end", "value")
    rows = spark.read.parquet(path).select(
        "genome", key.alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    before = F.lag("key").over(Window.partitionBy("genome", "file").orderBy("row"))
    files = rows.withColumn("before", before).groupBy("genome", "file").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") > F.col("key")).alias("wrong"),
        F.min("key").alias("first"), F.max("key").alias("last"))
    reach = F.max("last").over(Window.partitionBy("genome").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("reach", reach).groupBy("genome").agg(
        F.sum("n").alias("records"), F.sum("wrong").alias("out_of_order"),
        F.count_if(F.col("reach") > F.col("first")).alias("overlapping_files"))


@query("signal_sink", f"with {I.CLEAN} {_bins('clean', 'span_start', 'span_end', 'signal')}")
def signal_sink(spark, sf_dir):
    path = _folder(spark)
    clean = jobs.clean_signal(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean
    sinks.write_signal(clean, path, [1000, 4000, 16000], keys=("genome", "chrom"))
    return spark.read.parquet(f"{path}/summaries").drop("genome")


@query("gene_model_sink", f"""
with {ASSEMBLED}, {I.SIZES}
select s.name as chrom, a.tx_start, a.tx_end, coalesce(transcript_name, transcript_id) as name, exon_frames as frames,
       count(*) as models
from assembled a join sizes s on s.name = a.chrom or s.name = substr(a.chrom, 4)
where reason is null and tx_end <= s.size group by all
""")
def gene_model_sink(spark, sf_dir):
    path = _folder(spark)
    fields = land(records.gff3_fields(I.gff_lines(spark, sf_dir), "AdditionalSources"))
    found = jobs.gene_rows(records.with_attributes(fields), I.sizes(spark, sf_dir), keys=KEYS)
    sinks.write_gene_models(found.track.clean, path)
    return spark.read.parquet(path).groupBy(
        "chrom", F.col("chromStart").alias("tx_start"), F.col("chromEnd").alias("tx_end"), "name",
        V.joined_list("exonFrames").alias("frames"),
    ).agg(F.count("*").alias("models"))


@query("chrom_sizes_file", "select 'n7' as genome, s_name as name, s_suppkey * 10 as size from supplier")
def chrom_sizes_file(spark, sf_dir):
    path = _folder(spark)
    sizes = I.table(spark, sf_dir, "supplier").select(
        F.lit("n7").alias("genome"), F.col("s_name").alias("name"), (F.col("s_suppkey") * 10).alias("size")
    )
    sinks.write_chrom_sizes(sizes, path)
    return tables.read_chrom_sizes(spark, f"{path}/genome=n7", "n7")


@query("fasta_file_lengths", """
select 'asm' as genome, 'c' || cast(conv_id as varchar) as name,
       cast(sum(length(replace(replace(replace(replace(text, ' ', ''), chr(9), ''), chr(10), ''), chr(13), '')))
            as bigint) as size
from conversations group by conv_id
""")
def fasta_file_lengths(spark, sf_dir):
    path = _folder(spark)
    turns = I.table(spark, sf_dir, "conversations")
    heads = turns.groupBy("conv_id").agg(F.lit(-1).cast("bigint").alias("turn")).withColumn(
        "value", F.concat(F.lit(">c"), F.col("conv_id").cast("string"), F.lit(" a > b"))
    )
    lines = turns.select("conv_id", "turn", F.regexp_replace("text", "[\r\n]+", " ").alias("value"))
    # A record must stay together and in order for the text to be FASTA at all.
    whole = heads.unionByName(lines).repartitionByRange("conv_id").sortWithinPartitions("conv_id", "turn")
    whole.select("value").write.text(path)
    return fasta.fasta_chrom_sizes(spark, path, "asm")


@query("bed_files_job", f"""
with {I.HARMONISED}
select chrom, span_start as start_pos, span_end as end_pos, 'n' || cast(signal as varchar) as name, count(*) as records
from harmonised where known and span_end <= contig_size group by all
""")
def bed_files_job(spark, sf_dir):
    path = _folder(spark)
    I.intervals(spark, sf_dir).select(
        F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"),
                    F.concat(F.lit("n"), F.col("value").cast("string")))
    ).write.text(path)
    sheet = tables.list_track_files(spark, path, glob="*.txt").select(
        F.lit("r").alias("run"), F.lit("bed").alias("file_type"), "path", F.lit("asm").alias("genome")
    )
    clean = jobs.bed_job(spark, sheet, I.sizes(spark, sf_dir)).clean
    return clean.groupBy(
        "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("rest")[0].alias("name")
    ).agg(F.count("*").alias("records"))


@query("relative_paths_job", f"""
with {I.HARMONISED},
runs(run) as (values ('folder'), ('slashes'), ('up')),
tagged as (select run, case when not known then 'missing' when span_end <= contig_size then 'clean' else 'rejects' end as frame from harmonised, runs)
select case when frame = 'missing' then 'all' else run end as run, frame, count(*) as records from tagged group by all
""")
def relative_paths_job(spark, sf_dir):
    """One folder under three spellings: every record of each is in one of the frames."""
    path = _folder(spark)
    I.intervals(spark, sf_dir).select(
        F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("n"))
    ).write.text(f"{path}/bed[1]")
    for spelling in ("a", "b"):
        spark.read.text(literal_path(f"{path}/bed[1]")).write.text(f"{path}/{spelling}")
    sheet = spark.createDataFrame(
        [("folder", f"{path}/bed[1]"), ("slashes", f"{path}//a/"), ("up", f"{path}/a/../b")], "run string, path string"
    ).select("run", F.lit("bed").alias("file_type"), "path", F.lit("asm").alias("genome"))
    track = jobs.bed_job(spark, sheet, I.sizes(spark, sf_dir))
    counts = [track.clean.groupBy("run").agg(F.count("*").alias("records")).withColumn("frame", F.lit("clean")),
              track.rejects.groupBy("run").agg(F.count("*").alias("records")).withColumn("frame", F.lit("rejects")),
              track.missing.agg(F.sum("records").alias("records")).select(F.lit("all").alias("run"), "records", F.lit("missing").alias("frame"))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("directory_catalog", f"""
with {HUBS}
select file_type, 'GRCh38' as genome, count(*) as tracks
from sheet where file_type in ('bigwig', 'bigbed', 'bed', 'gff3') group by all
""")
def directory_catalog(spark, sf_dir):
    """Events as names of files under a folder, then a samplesheet and a catalog of them."""
    extension = "case file_type when 'bigwig' then 'bw' when 'bigbed' then 'bb' else file_type end"
    names = tables.samplesheet_rows(I.samplesheet(spark, sf_dir)).select(
        F.expr(f"concat('/d/run', run, '_x.', {extension})").alias("path"))
    sheet = jobs.sheet_rows(names, "hg38", "lab").drop("assembly_report")
    catalog = jobs.catalog_job(jobs.track_files(sheet), ensembl=True)
    return catalog.groupBy("file_type", "genome").agg(F.count("*").alias("tracks"))


@query("samplesheet_file", f"with {I.TRACKS} select run, file_type, path, genome, nullif(hub, '') as hub from sheet")
def samplesheet_file(spark, sf_dir):
    path = _folder(spark)
    I.samplesheet(spark, sf_dir).write.option("header", "true").csv(path)
    sheet = tables.read_samplesheet(spark, path)
    return sheet.select("run", "file_type", "path", "genome", F.nullif("hub", F.lit("")).alias("hub"))


@query("sample_metadata_file", f"""
with {METADATA}
select sample_id, short_label, long_label, color, visibility, priority,
       case when k % 3 = 0 then cast(k as varchar) end as height
from sheet_rows
""")
def sample_metadata_file(spark, sf_dir):
    # Part files follow one another in name order, and so do the rows.
    path = _folder(spark)
    placed = metadata_sheet(spark, sf_dir).repartitionByRange("row_order").sortWithinPartitions("row_order")
    placed.drop("row_order").write.option("header", "true").option("escape", '"').csv(path)
    return tables.read_sample_metadata(spark, path).select(
        "sample_id", "short_label", "long_label", "color", "visibility", "priority",
        F.col("additional_params")["height"].alias("height"),
    )


@query("track_files", f"""
with {I.TRACKS}
select run, genome, case when file_type in ('bigwig') then 'bigwig' else 'bigbed' end as track_type,
       case when file_type in ('bed', 'gff3') then run || '.bb' else path end as path
from sheet where file_type in ('bed', 'gff3', 'bigwig', 'bigbed')
""")
def track_files(spark, sf_dir):
    sheet = tables.samplesheet_rows(I.samplesheet(spark, sf_dir))
    return jobs.track_files(sheet).select("run", "genome", "track_type", "path")


@query("catalog_publish", f"""
with {HUBS} select hub_key as hub, genome, track_type, count(*) as tracks, min(path) as first_path from tracks group by all
""")
def catalog_publish(spark, sf_dir):
    path = _folder(spark)
    sheet = tables.samplesheet_rows(I.samplesheet(spark, sf_dir)).filter("file_type in ('bigwig', 'bigbed')")
    sinks.publish(jobs.catalog_job(jobs.track_files(sheet), "lab"), path)
    return spark.read.parquet(path).groupBy("hub", "genome", "track_type").agg(
        F.count("*").alias("tracks"), F.min("path").alias("first_path")
    )


@query("bedgraph_files_job", f"""
with {I.CLEAN}
select chrom, span_start as start_pos, span_end as end_pos, signal, count(*) as records from clean group by all
""")
def bedgraph_files_job(spark, sf_dir):
    path = _folder(spark)
    I.intervals(spark, sf_dir).select(
        F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"),
                    F.col("value").cast("string"))
    ).write.option("compression", "gzip").text(path)
    sheet = tables.list_track_files(spark, path, glob="*.txt.gz").select(
        F.lit("r").alias("run"), F.lit("bedgraph").alias("file_type"), "path", F.lit("asm").alias("genome")
    )
    clean = jobs.bedgraph_job(spark, sheet, I.sizes(spark, sf_dir)).clean
    return clean.groupBy(
        "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"),
        F.col("value").cast("bigint").alias("signal"),
    ).agg(F.count("*").alias("records"))


@query("gff3_files_job", f"""
with {ASSEMBLED}, {I.SIZES}
select s.name as chrom, a.tx_start, a.tx_end, coalesce(transcript_name, transcript_id) as name, gene_id,
       cast(exon_count as integer) as blocks, count(*) as models
from assembled a join sizes s on s.name = a.chrom or s.name = substr(a.chrom, 4)
where reason is null and tx_end <= s.size group by all
""")
def gff3_files_job(spark, sf_dir):
    path = _folder(spark)
    I.gff_lines(spark, sf_dir).select("value").write.text(path)
    sheet = tables.list_track_files(spark, path, glob="*.txt").select(
        F.lit("r").alias("run"), F.lit("gff3").alias("file_type"), "path", F.lit("asm").alias("genome")
    )
    clean = jobs.gff3_job(spark, sheet, I.sizes(spark, sf_dir), keys=("genome", "run")).track.clean
    return clean.groupBy(
        "chrom", F.col("chromStart").alias("tx_start"), F.col("chromEnd").alias("tx_end"), "name",
        F.col("geneName2").alias("gene_id"), F.col("blockCount").alias("blocks"),
    ).agg(F.count("*").alias("models"))


@query("sizes_files_job", f"""
with {I.REPORTS},
picked as (
  select b.genome, b.line, c.chosen, b.len,
         case c.chosen when 'ucsc-style-name' then coalesce(nullif(b.ucsc, 'na'), b.seq_name)
                       when 'refseq-accn' then coalesce(nullif(b.refseq, 'na'), b.seq_name)
                       when 'genbank-accn' then b.genbank else b.seq_name end as raw
  from body b left join choice c on c.genome = b.genome where b.s_nationkey % 7 <> 0),
named as (
  select genome, line, cast(len as bigint) as size,
         case when chosen = 'ucsc-style-name' then raw when regexp_full_match(raw, '[0-9]+') then 'chr' || raw
              else raw end as name
  from picked where regexp_full_match(len, '[0-9]+')),
reported as (select genome, name, arg_min(size, line) as size from named group by genome, name),
listed as (select distinct genome, 'only_' || genome as name, cast(7 as bigint) as size from body)
select * from reported
union all select * from listed where genome not in (select genome from reported)
""")
def sizes_files_job(spark, sf_dir):
    path = _folder(spark)

    def by_genome(lines, name):
        """One text file per genome, its lines in order; a genome has at most 1,000 suppliers."""
        placed = lines.repartition("genome").sortWithinPartitions("genome", "line").select("genome", "value")
        placed.write.partitionBy("genome").text(f"{path}/{name}")
        files = tables.list_track_files(spark, f"{path}/{name}", glob="*.txt")
        return files.select(F.regexp_extract("path", "genome=([^/]+)/", 1).alias("genome"), F.col("path").alias(name))

    without = "cast(regexp_extract(genome, '^n([0-9]+)_', 1) as int) % 7 = 0"
    reports = by_genome(I.report_lines(spark, sf_dir).filter(f"not ({without})"), "report")
    features = I.report_seqids(spark, sf_dir).select(
        "genome", F.concat("seqid", F.lit("\ts\tgene\t1\t9\t.\t+\t.\tID=x")).alias("value"), F.lit(0).alias("line")
    )
    annotations = by_genome(features, "gff")
    listed = I.table(spark, sf_dir, "supplier").select(
        F.expr(I.REPORT_GENOME).alias("genome"), F.concat(F.lit("only_"), F.expr(I.REPORT_GENOME)).alias("name"),
        F.lit(7).cast("bigint").alias("size"),
    ).distinct()
    sheet = listed.join(reports, "genome", "left").join(annotations, "genome", "left").select(
        F.col("name").alias("run"), F.lit("gff3").alias("file_type"), F.coalesce("gff", F.lit("")).alias("path"),
        "genome", F.coalesce("report", F.lit("")).alias("assembly_report"),
    )
    sheet = land(sheet)  # a samplesheet is a file that each step reads
    return jobs.sizes_job(spark, sheet, tables=listed)


@query("job_counts", f"""
with {I.HARMONISED},
tagged as (
  select *, case when not known then 'missing' when span_end > contig_size then 'rejects' else 'clean' end as frame from harmonised),
frames as (
  select 'bed' as job, frame as what, count(*) as records from tagged group by frame
  union all select 'bed', 'input', count(*) from tagged
  union all select 'bed', 'lines', count(*) from tagged
  union all select 'bedgraph', frame, count(*) from tagged where signal % 10 <> 3 group by frame
  union all select 'bedgraph', 'input', count(*) from tagged where signal % 10 <> 3
  union all select 'bedgraph', 'lines', count(*) from tagged
  union all select 'bedgraph', 'headers', count(*) from tagged where signal % 10 = 3)
select job, what, records from frames
""")
def job_counts(spark, sf_dir):
    """What two file jobs counted while they wrote their records, with gzipped bedGraph and header lines."""
    path, rows = _folder(spark), I.intervals(spark, sf_dir)
    record = F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.col("value").cast("string"))
    rows.select(record).write.text(f"{path}/bed")
    rows.select(F.when(F.col("value") % 10 == 3, F.concat(F.lit("#"), record)).otherwise(record)).write.option("compression", "gzip").text(f"{path}/graph")
    sheet = spark.createDataFrame([("r", "bed", f"{path}/bed", "asm"), ("s", "bedgraph", f"{path}/graph", "asm")],
                                  "run string, file_type string, path string, genome string")
    sizes = I.sizes(spark, sf_dir)
    counts = {"bed": jobs.bed_job(spark, sheet, sizes).counts, "bedgraph": jobs.bedgraph_job(spark, sheet, sizes).counts}
    found = [(job, what, n) for job, of in counts.items() for what, n in of.items()]
    return spark.createDataFrame(found, "job string, what string, records long")


_REGION = "(n_nationkey * 7919) % 90000"


def _region_sql(span):
    return f"""
with {I.CLEAN},
long_ones as (select chrom, span_start, case when signal % 50 = 0 then span_start + {span} else span_end end as span_end, signal from clean),
regions as (
  select n_nationkey as region, name as chrom, {_REGION} as region_start, {_REGION} + n_nationkey * 40 as region_end
  from nation join (select distinct name, row_number() over (order by name) as k from sizes) s on s.k = n_nationkey % 20 + 1)
select region, r.chrom, span_start as start_pos, span_end as end_pos, signal, count(*) as records
from regions r join long_ones l on l.chrom = r.chrom and span_start < greatest(region_end, region_start + 1)
  and greatest(span_end, span_start + 1) > region_start
group by all"""


@query("interval_region_reads", _region_sql(30_000))
def interval_region_reads(spark, sf_dir):
    """Records of many regions from a written and indexed table; every fiftieth value marks a span of 30,000 positions."""
    path, sizes = _folder(spark), I.sizes(spark, sf_dir)
    clean = jobs.clean_signal(I.intervals(spark, sf_dir), sizes).clean
    long_ones = clean.withColumn("end", F.when(F.col("value") % 50 == 0, F.col("start") + 30_000).otherwise(F.col("end")))
    sinks.write_intervals(long_ones, path)
    regions.write_index(spark, path, block_rows=1_000)
    numbered = sizes.select(F.col("name").alias("chrom"), F.row_number().over(Window.orderBy("name")).alias("k"))
    wanted = I.table(spark, sf_dir, "nation").join(numbered, F.col("k") == F.col("n_nationkey") % 20 + 1).select(
        F.lit("asm").alias("genome"), "chrom", F.expr(_REGION).cast("long").alias("start"),
        F.expr(f"{_REGION} + n_nationkey * 40").cast("long").alias("end"), F.col("n_nationkey").alias("number"))
    return regions.read_regions(spark, path, wanted).groupBy(
        F.col("region_number").alias("region"), "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"),
        F.col("value").alias("signal")).agg(F.count("*").alias("records"))


@query("interval_sink_ranges", f"""
with {I.CLEAN}
select count(*) as records, cast(0 as bigint) as out_of_order, cast(0 as bigint) as overlapping_files, true as even from clean
""")
def interval_sink_ranges(spark, sf_dir):
    """A table with a third of its records at one start, written in ranges of measured bytes: no file holds over twice the median."""
    path = _folder(spark)
    clean = jobs.clean_signal(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean
    hot = clean.withColumn("_hot", F.pmod(F.xxhash64("start", "value"), F.lit(3)) == 0)
    skewed = land(hot.select(
        "genome", F.when(F.col("_hot"), F.lit("chr2")).otherwise(F.col("chrom")).alias("chrom"),
        F.when(F.col("_hot"), F.lit(7)).otherwise(F.col("start")).alias("start"), F.col("end").alias("end"), "value"))
    size = skewed.agg(F.sum(row_bytes(skewed.schema))).first()[0]
    placed = clustered_by_bytes(skewed, per_range=size // 24, width=1_000)
    placed.write.partitionBy("genome").parquet(path)
    key = F.struct("chrom", "start", "end", "value")
    rows = spark.read.parquet(path).select(
        key.alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    files = rows.withColumn("before", before).groupBy("file").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") > F.col("key")).alias("wrong"), F.min("key").alias("first"), F.max("key").alias("last"))
    reach = F.max("last").over(Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    return files.withColumn("reach", reach).agg(
        F.sum("n").alias("records"), F.sum("wrong").alias("out_of_order"), F.count_if(F.col("reach") > F.col("first")).alias("overlapping_files"),
        (F.max("n") <= 2 * F.median("n")).alias("even"))


# Views of chr2: bins narrower than every summary, between two of them, and wider than all, none of them aligned.
VIEWS = [(137, 30_500, 333), (5, 90_001, 2_500), (1_234, 99_000, 17_001)]


def _view_sql(start, end, width):
    return f"""
select {width} as width, bin, cast(sum(bases) as bigint) as covered, cast(sum(v * bases) as bigint) as total,
       cast(sum(v * v * bases) as bigint) as total_sq, min(v) as low, max(v) as high
from (select bin, signal as v, least(span_end, {end}, {start} + (bin + 1) * {width}) - greatest(span_start, {start} + bin * {width}) as bases
      from (select *, unnest(generate_series((greatest(span_start, {start}) - {start}) // {width},
                                             (least(span_end, {end}) - 1 - {start}) // {width})) as bin
            from clean where chrom = 'chr2' and span_start < {end} and span_end > {start}) b) c
group by bin"""


@query("signal_zoom", f"with {I.CLEAN} {' union all '.join(_view_sql(*v) for v in VIEWS)}")
def signal_zoom(spark, sf_dir):
    path = _folder(spark)
    clean = jobs.clean_signal(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean
    sinks.write_signal(clean, path, [1000, 4000, 16000], keys=("genome", "chrom"))
    regions.write_index(spark, f"{path}/records")
    views = [zoom.read_zoom(spark, path, "asm", "chr2", *view, keys=("genome", "chrom"), reductions=[1000, 4000, 16000]).select(
        F.lit(view[2]).alias("width"), "bin", "covered", "total", "total_sq", "low", "high") for view in VIEWS]
    return views[0].unionByName(views[1]).unionByName(views[2])


def _placed(df):
    """``df`` with the position of each row in the order that it comes in: its place in its partition, after the rows of those before."""
    kept = land(df.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))
    counts = kept.groupBy("_part").agg(F.count("*").alias("_rows"))  # one row per partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return kept.join(F.broadcast(before), "_part").select(*df.columns, position.cast("int").alias("position"))


@query("interval_sort_order", f"""
with {I.CLEAN}
select chrom, span_start as start_pos, span_end as end_pos, signal,
       cast(row_number() over (order by genome, chrom, span_start, span_end, signal) as integer) as position from clean
""")
def interval_sort_order(spark, sf_dir):
    clean = jobs.clean_signal(I.intervals(spark, sf_dir), I.sizes(spark, sf_dir)).clean
    return _placed(intervals.sort_intervals(clean)).select(
        "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("value").alias("signal"), "position")


@query("multi_assembly_order", f"""
with {I.TRACKS}
select genome, path, cast(row_number() over (order by genome, path) as integer) as position from (select distinct genome, path from sheet) s
""")
def multi_assembly_order(spark, sf_dir):
    sheet = tables.samplesheet_rows(I.samplesheet(spark, sf_dir)).select("genome", "path")
    return _placed(catalog.multi_assembly(sheet.filter("length(path) % 2 = 0"), sheet)).select("genome", "path", "position")


@query("directory_job", f"""
with {I.HARMONISED},
named as (select *, 'chr' || cast(signal % 3 as varchar) as folder from harmonised),
clean as (select folder, count(*) as records, cast(sum(span_end - span_start) as bigint) as bases from named
          where known and span_end <= contig_size group by folder)
select folder, records, bases, cast(row_number() over (order by folder) as integer) as position from clean
""")
def directory_job(spark, sf_dir):
    """Track files written under folders, listed in order of their paths into a samplesheet, and read by its job; other files are left out."""
    path = _folder(spark)
    rows = I.intervals(spark, sf_dir).withColumn("folder", F.concat(F.lit("chr"), (F.col("value") % 3).cast("string")))
    columns = ["chrom", F.col("start").cast("string"), F.col("end").cast("string")]
    with folders_unsorted(spark):
        rows.select("folder", *columns).write.partitionBy("folder").option("sep", "\t").option("extension", "bed").csv(f"{path}/tracks")
    rows.limit(1).select("chrom").write.text(f"{path}/tracks/notes")
    listed = jobs.list_track_files(spark, f"{path}/tracks")
    place = _placed(listed.filter("path like '%.bed'")).groupBy(F.regexp_extract("path", "folder=([^/]+)/", 1).alias("folder")).agg(
        F.min("position").alias("_first"))
    order = place.select("folder", F.row_number().over(Window.orderBy("_first")).alias("position"))
    clean = jobs.bed_job(spark, jobs.directory_sheet(spark, f"{path}/tracks", "asm"), I.sizes(spark, sf_dir)).clean
    return clean.groupBy(F.regexp_extract("path", "folder=([^/]+)/", 1).alias("folder")).agg(
        F.count("*").alias("records"), F.sum(F.col("end") - F.col("start")).alias("bases")).join(order, "folder")
