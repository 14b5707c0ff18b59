"""Line deduplication by overlapping three-line windows. DataFrame functions only.

Every three consecutive lines of a text are hashed to 128 bits. A window that occurs at several places
of the corpus is kept at the first place, in order of doc_id, text key and line number; its later
occurrences are covered, and covered lines are removed. Each removed line has an equal
line at an earlier place that stays, so the content of a repeated passage always remains once.

Lines end at ``\\n``; a carriage return belongs to its line. A window of blank lines only never counts.
Texts of fewer than three lines have no window and stay.

Defined cases: a null text stays null, with no lines; an empty text has one empty line. Null ids come
last. Rows of equal id and text are one document and get equal results. A text that loses every line
becomes empty, its row stays. An empty table gives no rows. Other columns are
kept; one that has the name of a result is replaced.
"""

from pyspark.sql import functions as F

from .common import keyed_join, land, let, others, text_key

WINDOW = 3


def _windows(documents, size):
    """(doc_id, key, pos, h1, h2): every window of ``size`` lines, two independent 64-bit hashes each."""
    lines = documents.select("doc_id", text_key(F.col("text")).alias("key"), F.split("text", "\n", -1).alias("lines"))

    def window(_, i):
        parts = [F.get("lines", i + k) for k in range(size)]
        return F.struct(i.alias("pos"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"),
                        (F.trim(F.concat(*parts)) == "").alias("blank"))

    firsts = F.slice("lines", 1, F.greatest(F.size("lines") - (size - 1), F.lit(0)))
    return (
        lines.filter(F.size("lines") >= size)
        .select("doc_id", "key", F.inline(F.transform(firsts, window)))
        .filter(~F.col("blank"))
        .drop("blank")
    )


def later_windows(documents, size=WINDOW):
    """(doc_id, key, hits): the start lines of windows that occur at an earlier place, per document."""
    windows = _windows(documents, size)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "key", "pos")
    repeated = land(
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("h1", "h2", "first")
    )
    return (
        keyed_join(windows, repeated, ["h1", "h2"], "inner")
        .filter(place > F.col("first"))
        .groupBy("doc_id", "key")
        .agg(F.collect_set("pos").alias("hits"))
    )


def dedup_lines(documents, size=WINDOW):
    """``documents`` with the later occurrences cut out of ``text``, and ``n_lines`` and ``n_removed``.

    ``n_chars``, where the table has it, follows the new text of the documents that changed.
    """
    hits = land(later_windows(documents, size))
    keyed = documents.withColumn("_key", text_key(F.col("text")))
    joined = keyed_join(keyed, hits.select("doc_id", F.col("key").alias("_key"), F.col("hits").alias("_hits")),
                        ["doc_id", "_key"])
    lines = F.split("text", "\n", -1)

    def cut(parts):
        covered = F.flatten(F.transform("_hits", lambda i: F.sequence(i, i + (size - 1))))
        kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), covered)
        return F.struct(F.size(kept).alias("n"), F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n").alias("text"))

    out = (
        joined.withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"))
        .withColumn("_kept", F.when(F.col("_hits").isNotNull(), let(lines, cut)))
        .withColumn("n_removed", F.coalesce(F.col("n_lines") - F.col("_kept.n"), F.lit(0)).cast("long"))
        .withColumn("text", F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.col("_kept.text")))
    )
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("_kept").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(documents.schema["n_chars"].dataType)))
    return out.select(*others(documents, "n_lines", "n_removed"), "n_lines", "n_removed")


def op5_line_dedup(spark, sf_dir):
    from .common import read_table

    return dedup_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


OP5_SQL = r"""
with l as (
  select doc_id, md5(text) as key, string_split(text, chr(10)) as lines from (select distinct doc_id, text from documents)
  where text is not null),
w as (
  select doc_id, key, pos, lines[pos] || chr(10) || lines[pos + 1] || chr(10) || lines[pos + 2] as win
  from (select *, unnest(range(1, len(lines) - 1)) as pos from l where len(lines) >= 3)
  where trim(lines[pos] || lines[pos + 1] || lines[pos + 2], ' ') <> ''),
later as (
  select doc_id, key, pos from (
    select *, row_number() over (partition by win order by doc_id nulls last, key, pos) as r from w) where r > 1),
covered as (
  select distinct doc_id, key, unnest(range(pos, pos + 3)) as pos from later),
kept as (
  select l.doc_id, l.key, string_agg(l.line, chr(10) order by l.pos) as text, count(*) as n
  from (select doc_id, key, unnest(lines) as line, generate_subscripts(lines, 1) as pos from l) l
  anti join covered c on l.doc_id is not distinct from c.doc_id and l.key = c.key and l.pos = c.pos
  group by 1, 2),
touched as (select distinct doc_id, key from covered)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines,
       case when t.key is null then 0 else len(string_split(d.text, chr(10))) - coalesce(k.n, 0) end::bigint as n_removed,
       case when t.key is null then d.text else coalesce(k.text, '') end as text
from documents d
left join touched t on d.doc_id is not distinct from t.doc_id and md5(d.text) = t.key
left join kept k on d.doc_id is not distinct from k.doc_id and md5(d.text) = k.key
"""
