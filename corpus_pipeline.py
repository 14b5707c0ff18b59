"""A corpus pipeline over ``documents``: language, repeated lines, near duplicates, benchmark passages, mixture.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns them with the
columns of ``documents``; the last also numbers the copies it draws. Between stages the rows are written as Parquet and read back.

Columns beyond those of ``documents`` pass through unread, whatever their names. Null and empty texts: the language
stage rejects them, so none reach the others from there; see each operator for what it does with them otherwise. Documents that lose all
lines stay as empty texts. Rows with a null doc_id are never near duplicates. An empty table gives no rows at every stage.
"""

from pyspark.sql import functions as F

from trackspark.llm import decontaminate, language, lines, minhash, mixing
from trackspark.llm.common import keyed_join, land, read_table


def _packed(docs, *columns):
    """The named columns beside the whole row, so that no other name can clash."""
    return docs.select(*columns, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))


def _unpacked(docs, packed, **changed):
    return packed.select(*(changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns))


def identify_languages(spark, docs, sf_dir):
    """Drop documents of which no language can be told: null texts and texts without a letter."""
    model = language.fit_on_documents(docs)
    found = language.identify(_packed(docs, "text"), model)
    return _unpacked(docs, found.filter(F.col("lang_pred") != language.UNKNOWN))


def remove_repeated_lines(spark, docs, sf_dir):
    """Cut later occurrences of every three consecutive lines; ``n_chars`` follows the text."""
    columns = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    cut = lines.dedup_lines(_packed(docs, *columns))
    return _unpacked(docs, cut, **{c: F.col(c) for c in columns})


def drop_near_duplicates(spark, docs, sf_dir):
    """Keep one document of each group of near duplicates, that of least doc_id."""
    judged = minhash.near_duplicates(docs.select("doc_id", "text"))
    dropped = land(judged.filter(~F.col("kept")).select(F.col("doc_id").alias("_dropped")).distinct())
    packed = _packed(docs, "doc_id").withColumn("_dropped", F.col("doc_id").cast("long"))
    return _unpacked(docs, keyed_join(packed, dropped.withColumn("_gone", F.lit(True)), ["_dropped"]).filter(F.col("_gone").isNull()))


def drop_contaminated(spark, docs, sf_dir):
    """Drop documents that hold a window of a benchmark item."""
    return _unpacked(docs, decontaminate.clean_documents(_packed(docs, "text"), read_table(spark, sf_dir, "benchmark")))


def mix_to_weights(spark, docs, sf_dir):
    """Draw documents so that each source comes near its target; ``copy`` counts from 1."""
    drawn = mixing.mix_documents(_packed(docs, "doc_id", "text", "source"))
    rest = [c for c in docs.columns if c != "copy"]
    return drawn.select(*(F.col(f"_doc.`{c}`").alias(c) for c in rest), "copy")


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", remove_repeated_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_to_weights),
]


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = land(docs)
    return docs


#: SQL can't express the language stage; tests hold each stage against a brute-force version.
ORACLE_SQL = None
