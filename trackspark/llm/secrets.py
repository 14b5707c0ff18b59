"""Secret scan with corpus-wide ownership. DataFrame functions only.

Each text is scanned once per kind. Matches are set off by a separator that no text holds, so that one split
gives texts and matches in turn and running sums of lengths give their places, in time linear in the text.

Every value found is hashed and counted over the corpus: in how many repositories, and of how many owners, it
stands. A value of many owners is a widely copied example; one of few owners looks live, in however many of their repositories it
stands. A repository is a document here, and an owner its ``source``, of which this corpus has about twenty. Besides
the base kinds, a long mixed string that looks like no known kind is taken as a ``token`` if it is live-looking and
overlaps no base span. Copies of a text are scanned once.

Defined cases: null and empty texts have no spans. Null owners count as one owner, null repositories as none. Repeated
rows share one scan and each get a row. Empty tables give no rows. Other columns are
kept; one that has the name of a result is replaced.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import keyed_join, land, others, text_key

# Kind, pattern, what of the match must reach which length. In the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (
    ("assign", ASSIGN, 8),
    ("access", r"AKIA[A-Z0-9]+", 16),
    ("hex", r"[0-9a-f]{32,}", 32),  # maximal runs either way
    ("token", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", 20),
)
BASE = ("assign", "access", "hex")
COPIED_OWNERS = 3  # a value of this many owners is a copied example


def _has(kind, text):
    """A cheap test that no text with a match of the kind fails."""
    if kind == "access":
        return F.contains(text, F.lit("AKIA"))
    if kind == "assign":
        low = F.lower(text)
        found = F.lit(False)
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            found = found | F.contains(low, F.lit(word))
        return found
    return F.rlike(text, F.lit(dict((k, p) for k, p, _ in KINDS)[kind]))


def scan(texts):
    """(key, kind, rank, start, end, value): the spans of every distinct text of (key, text)."""
    clean = F.translate("text", "\0", "\x01")  # of equal length; neither is part of any pattern
    parts = F.array(*(
        F.struct(F.lit(rank).alias("rank"), F.when(_has(kind, F.col("text")), F.split(
            F.regexp_replace(clean, F.lit(f"({pattern})"), F.lit("\0$1\0")), "\0", -1)).alias("parts"))
        for rank, (kind, pattern, _) in enumerate(KINDS)))
    found = (
        texts.select("key", F.filter(parts, lambda x: F.size(x["parts"]) > 1).alias("found"))
        .filter(F.size("found") > 0)
        .dropDuplicates(["key"])
    )
    pieces = found.select("key", F.inline("found")).select("key", "rank", F.inline(F.transform(
        "parts", lambda p, i: F.struct(i.alias("at"), F.length(p).alias("n"), F.when(i % 2 == 1, p).alias("match")))))
    along = Window.partitionBy("key", "rank").orderBy("at")
    placed = pieces.withColumn("end", F.sum("n").over(along)).filter(F.col("match").isNotNull())
    value, enough = F.col("match"), F.lit(False)
    for rank, (kind, pattern, least) in enumerate(KINDS):
        here = F.col("rank") == rank
        if kind == "assign":
            value = F.when(here, F.regexp_extract("match", pattern, 1)).otherwise(value)
        enough = enough | (here & (F.length("value") >= least))
    mixed = F.rlike("value", F.lit("[0-9]")) & F.rlike("value", F.lit("[A-Za-z]"))
    names = F.array(*(F.lit(k) for k, _, _ in KINDS))
    return (
        placed.withColumn("value", value)
        .filter(enough & ((F.col("rank") < len(BASE)) | mixed))
        .select("key", F.get(names, F.col("rank")).alias("kind"), "rank", (F.col("end") - F.col("n")).alias("start"), "end", "value")
    )


def ownership(spans, holders):
    """(print, repositories, owners) per hash of a value; ``holders`` has a row (key, owner, repository) wherever a text stands.

    Distinct values are counted before and after the shuffle by each of them, so a value that stands in very many places is
    spread over its places first.
    """
    held = spans.select("key", F.sha2("value", 256).alias("print")).distinct()
    owner = F.coalesce(F.concat(F.lit("="), F.col("owner").cast("string")), F.lit(""))
    places = held.join(holders, "key").select("print", owner.alias("owner"), "repository").distinct()
    repositories = places.select("print", "repository").distinct().groupBy("print").agg(F.count("repository").alias("repositories"))
    owners = places.select("print", "owner").distinct().groupBy("print").agg(F.count("*").alias("owners"))
    return repositories.join(owners, "print")


def find_secrets(documents, repository="doc_id", owner="source", copied_owners=COPIED_OWNERS):
    """(key, kind, rank, start, end, value, print, repositories, owners, live) per span of a distinct text."""
    texts = documents.select(text_key(F.col("text")).alias("key"), "text").filter(F.col("text").isNotNull())
    spans = land(scan(texts))
    keys = spans.select("key").distinct()
    rows = documents.select(text_key(F.col("text")).alias("key"), F.col(owner).alias("owner"), F.col(repository).alias("repository"))
    holders = keyed_join(rows, keys, ["key"], "inner")
    owned = land(ownership(spans, holders))
    known = keyed_join(spans.withColumn("print", F.sha2("value", 256)), owned, ["print"])
    known = known.withColumn("live", F.col("owners") < copied_owners)
    base = F.col("rank") < len(BASE)
    order = Window.partitionBy("key").orderBy("start", "end", "rank")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    apart = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    return known.withColumn("_apart", apart).filter(base | (F.col("live") & F.col("_apart"))).drop("_apart")


def summarise(documents, spans):
    """A row per row of ``documents`` with what was found in its text."""
    def listed(only_base):
        item = F.struct("start", "rank", F.concat_ws(":", "kind", "start", "end").alias("span"))
        items = F.collect_list(F.when(F.col("rank") < len(BASE), item) if only_base else item)
        return F.array_join(F.transform(F.sort_array(items), lambda x: x["span"]), ",")

    per_text = spans.groupBy("key").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k, _, _ in KINDS),
        listed(True).alias("base"), listed(False).alias("spans"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"))
    numbers = [f"n_{k}" for k, _, _ in KINDS] + ["n_live", "n_copied"]
    found = per_text.select(F.col("key").alias("_key"), F.struct(*numbers, "base", "spans").alias("_found"))
    joined = keyed_join(documents.withColumn("_key", text_key(F.col("text"))), land(found), ["_key"])
    return joined.select(
        *others(documents, *numbers, "base", "spans"), *(F.coalesce(f"_found.{n}", F.lit(0)).cast("long").alias(n) for n in numbers),
        F.coalesce("_found.base", F.lit("")).alias("base"), F.coalesce("_found.spans", F.lit("")).alias("spans"))


def op9_secret_scan(spark, sf_dir):
    from .common import read_table

    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return summarise(documents, find_secrets(documents)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
        "n_token", "n_live", "n_copied")


OP9_SQL = r"""
with t as (select distinct md5(text) as key, text from documents where text is not null),
kinds(kind, rank, pattern, least) as (values
  ('assign', 0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 8),
  ('access', 1, 'AKIA[A-Z0-9]+', 16), ('hex', 2, '[0-9a-f]{32,}', 32), ('token', 3, '[A-Za-z0-9+/_-]{20,}', 20)),
found as (
  select key, kind, rank, least, regexp_extract_all(text, pattern) as m, string_split_regex(text, pattern) as p,
         case when kind = 'assign' then regexp_extract_all(text, pattern, 1) else regexp_extract_all(text, pattern) end as v
  from t, kinds where regexp_matches(text, pattern)),
parts as (select key, kind, rank, least, unnest(m) as m, unnest(p[1:len(m)]) as p, unnest(v) as v, generate_subscripts(m, 1) as i from found),
spans as (
  select key, kind, rank, v,
         sum(length(p) + length(m)) over w - length(m) as s, sum(length(p) + length(m)) over w as e, least
  from parts window w as (partition by key, kind order by i)),
good as (
  select key, kind, rank, v, s::bigint as s, e::bigint as e from spans
  where length(v) >= least and (kind <> 'token' or (regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]')))),
owners as (
  select v, count(distinct coalesce('=' || d.source, '')) as owners
  from good join documents d on md5(d.text) = good.key group by v),
known as (select g.*, owners < 3 as live from good g join owners o on g.v = o.v),
kept as (
  select * from known k where rank < 3 or (live and not exists (
    select 1 from known b where b.key = k.key and b.rank < 3 and b.s < k.e and b.e > k.s))),
per as (
  select key, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
         count(*) filter (kind = 'hex') as n_hex, count(*) filter (kind = 'token') as n_token,
         count(*) filter (live) as n_live, count(*) filter (not live) as n_copied,
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 3), '') as base,
         string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans from kept group by key)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
       coalesce(n_token, 0)::bigint as n_token, coalesce(n_live, 0)::bigint as n_live, coalesce(n_copied, 0)::bigint as n_copied
from documents left join per on md5(text) = per.key
"""
