"""Benchmark decontamination by winnowing. DataFrame functions only.

Words are hashed, every ``GRAM`` consecutive words form a gram, and of the grams in each window of
``WINDOW`` words the least hash is kept. Two equal windows keep the same hash, so joining
the kept hashes of documents and benchmark items finds every shared span of ``WINDOW`` words or more; most
documents share none and are read once. For those that do, the windows with a shared hash are extended to
the whole window and compared word by word, so that a chance hash never counts.

An item of fewer words than a window is one window of its own length; all grams of these lengths, few as
they are, are taken without winnowing.

Defined cases: a null text has no words; items without words match nothing. Items are told apart by
item_id; a null item_id marks words as hit but is not counted or listed. Rows of equal text share one computation, so repeated rows and null or
repeated doc_ids each get a row of their own. Empty tables give no hits, or no rows. Other columns are kept; one that has the name of a result is replaced.
"""

from pyspark.sql import functions as F

from .common import MARKS, ascii_lower, keyed_join, land, let, others, split_words, text_key

WINDOW = 10
GRAM = 5


def words_of(text):
    """The words of a text in ASCII lower case; none for null."""
    return split_words(ascii_lower(text), MARKS)


def _starts(array, span):
    """Positions at which ``span`` elements of ``array`` begin."""
    return F.when(F.size(array) >= span, F.sequence(F.lit(1), F.size(array) - (span - 1))).otherwise(
        F.array().cast("array<int>")
    )


def _grams(hashes, length, *salt):
    """The hash of every ``length`` words in a row, from word hashes."""
    return F.transform(_starts(hashes, length), lambda i: F.xxhash64(*salt, F.slice(hashes, i, length)))


def _short(hashes, length):
    """The hash of every ``length`` words, apart from those of other lengths."""
    return _grams(hashes, length, F.lit(length))


def _kept(hashes, window, gram):
    """The kept hash of each window of ``window`` words, in order."""
    return let(_grams(hashes, gram), lambda g: F.transform(
        _starts(hashes, window), lambda i: F.array_min(F.slice(g, i, window - gram + 1))))


def _prints(words, window, gram, lengths):
    """The kept hashes of a text and all hashes of the short lengths."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.array_distinct(
        F.concat(_kept(h, window, gram), *(_short(h, n) for n in lengths))))


def _spans(words, hashes, length, wanted=None):
    """Whole windows with their hashes: (start, len, print, span); only those whose hash is wanted."""
    at = F.when(F.size(hashes) > 0, F.sequence(F.lit(1), F.size(hashes))).otherwise(F.array().cast("array<int>"))
    if wanted is not None:
        at = F.filter(at, lambda i: F.array_contains(wanted, F.get(hashes, i - 1)))
    return F.transform(at, lambda i: F.struct(
        i.alias("start"), F.lit(length).alias("len"), F.get(hashes, i - 1).alias("print"),
        F.concat_ws(" ", F.slice(words, i, length)).alias("span")))


def _all_spans(words, window, gram, lengths, wanted=None):
    def of(h):
        parts = [let(_kept(h, window, gram), lambda m: _spans(words, m, window, wanted))]
        parts += [short(h, n) for n in lengths]
        return F.concat(*parts)

    def short(h, n):
        return let(_short(h, n), lambda m: _spans(words, m, n, wanted))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _item_windows(items, window, gram):
    """(item_id, len, print, span): the windows of all items, and the short lengths that occur."""
    items = items.select("item_id", words_of(F.col("text")).alias("words"))
    sizes = items.filter(F.size("words").between(1, window - 1)).select(F.size("words")).distinct()
    lengths = sorted(row[0] for row in sizes.collect())  # under ``window`` values
    spans = let(F.col("words"), lambda w: _all_spans(w, window, gram, lengths))
    windows = items.select("item_id", F.size("words").alias("_n"), F.inline(spans))
    return windows.filter(F.col("len") == F.least("_n", F.lit(window))).drop("_n", "start"), lengths


def _read_once(documents, prints, window, gram, lengths):
    """(key, n_words, print): one row per row of ``documents`` with print null, and one per shared hash.

    The only pass over all texts. The row without a hash carries the word count.
    """
    def rows(words):
        return F.struct(F.size(words).alias("n_words"), F.concat(
            F.array(F.lit(None).cast("bigint")), _prints(words, window, gram, lengths)).alias("prints"))

    read = documents.select(text_key(F.col("text")).alias("key"), let(words_of(F.col("text")), rows).alias("_read"))
    found = read.select("key", F.col("_read.n_words").alias("n_words"), F.explode("_read.prints").alias("print"))
    marked = keyed_join(found, prints.withColumn("shared", F.lit(True)), ["print"])
    return marked.filter(F.col("print").isNull() | F.col("shared")).drop("shared")


def benchmark_hits(documents, items, window=WINDOW, gram=GRAM):
    """Two tables by text key: (key, n_words) of all texts, and (key, n_hit, item_ids) of those with hits."""
    item_windows, lengths = _item_windows(items, window, gram)
    item_windows = land(item_windows)
    read = land(_read_once(documents, item_windows.select("print").distinct(), window, gram, lengths))
    sizes = read.filter(F.col("print").isNull()).groupBy("key").agg(F.max("n_words").alias("n_words"))
    shared = land(read.filter(F.col("print").isNotNull()).groupBy("key").agg(F.collect_set("print").alias("wanted")))

    texts = documents.select(text_key(F.col("text")).alias("key"), "text")
    suspects = keyed_join(texts, shared, ["key"], "inner").dropDuplicates(["key"])
    spans = suspects.select("key", F.inline(let(
        words_of(F.col("text")), lambda w: _all_spans(w, window, gram, lengths, F.col("wanted")))))
    item_spans = item_windows.select("len", "print", "span", "item_id").distinct()
    hits = land(keyed_join(spans, item_spans, ["print", "len", "span"], "inner").select("key", "start", "len", "item_id"))
    hit_words = (
        hits.select("key", "start", "len").distinct()
        .select("key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("at"))
        .distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    )
    hit_items = hits.select("key", F.col("item_id").cast("string").alias("item_id")).distinct().groupBy("key").agg(
        F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    return sizes, hit_words.join(hit_items, "key")


def contamination(documents, items, window=WINDOW, gram=GRAM):
    """``documents`` with n_words, n_hit, item_ids (sorted strings) and contaminated."""
    sizes, hits = benchmark_hits(documents, items, window, gram)
    found = land(sizes.join(hits, "key", "left")).select(
        F.col("key").alias("_key"), F.struct("n_words", "n_hit", "item_ids").alias("_found"))
    joined = keyed_join(documents.withColumn("_key", text_key(F.col("text"))), found, ["_key"])
    return joined.select(
        *others(documents, "n_words", "n_hit", "item_ids", "contaminated"),
        F.coalesce("_found.n_words", F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("_found.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("_found.item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("_found.n_hit").isNotNull().alias("contaminated"),
    )


def clean_documents(documents, items, window=WINDOW, gram=GRAM):
    """The rows of ``documents`` without a hit, all columns as they are."""
    _, hits = benchmark_hits(documents, items, window, gram)
    keys = land(hits.select(F.col("key").alias("_key"), F.lit(True).alias("_hit")))
    keyed = documents.withColumn("_key", text_key(F.col("text")))
    return keyed_join(keyed, keys, ["_key"]).filter(F.col("_hit").isNull()).drop("_key", "_hit")


def op2_decontaminate(spark, sf_dir):
    from .common import read_table

    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(documents, read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


OP2_SQL = r"""
with docs as (
  select md5(text) as key, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low
  from (select distinct text from documents where text is not null)),
d as (select key, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from docs),
i as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark where text is not null),
iw as (
  select distinct item_id, least(len(words), 10) as n, array_to_string(words[s:s + least(len(words), 10) - 1], ' ') as span
  from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as s from i where len(words) > 0)),
lens as (select distinct n from iw),
dw as (
  select key, n, s, array_to_string(words[s:s + n - 1], ' ') as span
  from (select d.key, d.words, n, unnest(range(1, len(words) - n + 2)) as s from d, lens where len(words) >= n)),
hits as (select dw.key, dw.s, dw.n, iw.item_id from dw join iw on dw.span = iw.span and dw.n = iw.n),
words_hit as (
  select key, count(distinct p) as n_hit from (select key, unnest(range(s, s + n)) as p from hits) group by key),
items_hit as (
  select key, count(distinct item_id::varchar) as n_items,
         string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from hits group by key)
select doc_id, coalesce(len(d.words), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from documents left join d on md5(text) = d.key
left join words_hit w on w.key = d.key left join items_hit t on t.key = d.key
"""
