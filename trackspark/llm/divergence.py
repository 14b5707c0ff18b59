"""Source divergence audit: which terms, and which other sources, set a source of a language apart.

Terms are runs of letters and of characters beyond ASCII, with A-Z in lower case. A language keeps the terms that are in at least
``MIN_DOCS`` of its documents. A group (lang, source), and the language as a whole, gives each kept term the smoothed share
p = 1 + floor(1e9 * (count + 1) / (N + V)); the divergence of shares p from q is floor((p - q)^2 / q). All arithmetic
is on integers.

Pairs. The divergence of a group from another source is summed over all kept terms, also those that neither has. Only terms in
both sources need a joint count: the terms that one side has alone depend on its count only, so a histogram of counts gives
them, and the terms in neither are counted by inclusion and exclusion. The join on terms thus makes a row for each kept
(source, term) and other source with that term; sums combine before the shuffle.

Terms. The divergence grows with a term's count in the group and falls with its count in the language, and ties go to the
earlier term. A term that ``TOP`` others dominate in all three can't be among the first ``TOP``. Every partition therefore keeps
only its skyband, the terms dominated by fewer than ``TOP`` others; skybands are merged by salted parts of a group and cut
again; what remains is ranked exactly. A partition holds at most ``BUFFER`` terms at a time, whatever the group's size.

Defined cases: null text, lang and source are ''. Every row of ``documents`` is a document, repeated rows included. A
language without kept terms gives its pairs the value 0 and no terms. A source alone in its language has no pairs. Long texts
are split in slabs. An empty table gives no rows. Columns beyond text, lang and source are never read.
"""

from collections import Counter

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import keyed_join, land, read_table
from .tokens import SLAB, slices

# Bytes of terms, with A-Z in lower case; all others separate terms.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 0x20 for b in range(256))
MIN_DOCS = 3
TOP = 200
BUFFER = 100_000
HELD = 500_000  # different terms of groups that a task counts before it hands them on
SALTS = 16


def _words_of(data):
    """Lists of the terms of one text; a long text gives several, so that not all its terms are held at once."""
    data = data.translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLAB)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count_terms(limit):
    """Rows (lang, source, term, n, docs) of the texts so far, each time that more than ``limit`` of them are held."""
    def rows(held):
        import pyarrow as pa

        for (lang, source), (n, docs) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(n)), pa.repeat(source, len(n)), pa.array(list(n), pa.binary()).view(pa.string()),
                 pa.array(list(n.values()), pa.int64()), pa.array([docs[term] for term in n], pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    def run(batches):
        import pyarrow as pa

        held, size = {}, 0
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for *group, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
                n, docs = held.setdefault(tuple(group), (Counter(), Counter()))
                size -= len(n)
                found = set()
                for words in _words_of(text):
                    n.update(words)
                    found.update(words)
                docs.update(found)
                size += len(n)
                if size > limit:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)
    return run


def term_counts(documents, limit=HELD):
    """(lang, source, term, n, docs): occurrences of each term in a group and the number of documents that hold it.

    A task counts the terms of its texts first, so that only different ones leave it. The rows lie by (lang, term).
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return (
        documents.select(blank("lang"), blank("source"), blank("text"))
        .mapInArrow(_count_terms(limit), "lang string, source string, term string, n long, docs long")
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _share(count, total, vocabulary):
    """SQL of p for a count, exact; null without a vocabulary."""
    return (f"(1 + cast(1000000000 as decimal(10,0)) * cast({count} + 1 as decimal(20,0))"
            f" div cast(if({vocabulary} = 0, null, {total} + {vocabulary}) as decimal(20,0)))")


def _divergence(p, q):
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def audit_tables(documents, min_docs=MIN_DOCS):
    """(kept, groups): counts of kept terms, one row per (lang, source, term), and the totals of every group."""
    term = Window.partitionBy("lang", "term")
    counts = term_counts(documents).withColumns({
        "lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term), "first": F.col("source") == F.min("source").over(term)})
    kept = land(counts.filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first"))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = documents.select(blank("lang"), blank("source")).distinct()
    found = land(kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("found"), F.count_if("first").alias("firsts")))
    groups = keyed_join(groups, found.drop("firsts"), ["lang", "source"])
    groups = keyed_join(groups, found.groupBy("lang").agg(F.sum("firsts").alias("vocabulary"), F.sum("total").alias("lang_total")), ["lang"])
    return kept, land(groups.na.fill(0).withColumn("rest", F.expr(_share(0, "total", "vocabulary"))))


def source_pairs(kept, groups):
    """(lang, source, item, value): the divergence of every group from each other source of its language."""
    mine = groups.select("lang", "source", "found", "vocabulary", F.col("rest").alias("p0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("found").alias("other_found"), F.col("rest").alias("q0"))
    apart = F.col("source") != F.col("item")
    pairs = mine.join(other, "lang").filter(apart)
    neither = pairs.select("lang", "source", "item", F.expr(
        f"if(vocabulary = 0, 0, (vocabulary - found - other_found) * {_divergence('p0', 'q0')})").alias("v"))

    shares = keyed_join(kept, groups.select("lang", "source", "total", "vocabulary", "rest"), ["lang", "source"], "inner").withColumn(
        "p", F.expr(_share("n", "total", "vocabulary")))
    counts = shares.groupBy("lang", "source", "p", "rest").agg(F.count("*").alias("terms"))
    alone = counts.join(other, "lang").filter(apart)
    own = alone.select("lang", "source", "item", F.expr(f"terms * {_divergence('p', 'q0')}").alias("v"))
    theirs = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                          F.expr(f"terms * {_divergence('q0', 'p')}").alias("v"))

    side = shares.select("lang", "term", "source", "p", "rest")
    # Both sides are one frame under two names, so that it is shuffled once.
    met = side.alias("a").join(side.hint("merge").alias("b"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("lang", "term")])
    both = met.filter("a.source != b.source").select("a.lang", "a.source", F.col("b.source").alias("item"), F.expr(
        f"{_divergence('a.p', 'b.p')} - {_divergence('a.p', 'b.rest')} - {_divergence('a.rest', 'b.p')} + {_divergence('a.rest', 'b.rest')}").alias("v"))
    parts = [part.groupBy("lang", "source", "item").agg(F.sum("v").alias("v")) for part in (neither, own, theirs, both)]
    total = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return total.groupBy("lang", "source", "item").agg(F.sum("v").alias("value"))


class _Dominators:
    """Counts, up to k, how many terms added so far have a language count and a place no greater than given ones.

    A tree of prefix sums over the language counts; each node holds the k least places below it, sorted.
    """

    def __init__(self, size, k):
        self.nodes, self.k = [[] for _ in range(size + 1)], k

    def count(self, at, place):
        from bisect import bisect_left

        found = 0
        while at and found < self.k:
            found += bisect_left(self.nodes[at], place)
            at -= at & -at
        return found

    def add(self, at, place):
        from bisect import insort

        while at < len(self.nodes):
            node = self.nodes[at]
            if len(node) < self.k or place < node[-1]:
                insort(node, place)
                del node[self.k:]
            at += at & -at


def skyband(n, lang_n, place, k):
    """Mask of the terms that fewer than ``k`` others dominate: with n no less, lang_n no greater and a lesser place.

    The arrays must be sorted by n downwards, then lang_n and place upwards, so dominators come first.
    """
    levels, at = np.unique(lang_n, return_inverse=True)
    tree, alive = _Dominators(len(levels), k), np.zeros(len(n), bool)
    new = np.ones(len(n), bool)
    new[1:] = (n[1:] != n[:-1]) | (lang_n[1:] != lang_n[:-1])
    begins = np.flatnonzero(new)
    turn = np.arange(len(n)) - np.repeat(begins, np.diff(np.append(begins, len(n))))
    for i in np.flatnonzero(turn < k):  # of equal counts only the k first can stay
        level, where = int(at[i]) + 1, int(place[i])
        if tree.count(level, where) < k:
            alive[i] = True
            tree.add(level, where)
    return alive


def _cut(table, k):
    """The skybands of all groups of an Arrow table."""
    import pyarrow as pa
    import pyarrow.compute as pc

    order = pc.sort_indices(table, [("lang", "ascending"), ("source", "ascending"), ("n", "descending"),
                                    ("lang_n", "ascending"), ("term", "ascending")])
    place = np.empty(len(table), np.int64)
    place[pc.sort_indices(table.column("term")).to_numpy()] = np.arange(len(table))
    table, place = table.take(order), place[order.to_numpy()]
    starts = np.ones(len(table), bool)
    for c in ("lang", "source"):
        code = table.column(c).combine_chunks().dictionary_encode().indices.to_numpy()
        starts[1:] = (starts[1:] & False if c == "lang" else starts[1:]) | (code[1:] != code[:-1])
    edges = [*np.flatnonzero(starts), len(table)]
    n, lang_n = table.column("n").to_numpy(), table.column("lang_n").to_numpy()
    alive = [skyband(n[a:b], lang_n[a:b], place[a:b], k) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return table.filter(pa.array(np.concatenate(alive)))


def _skybands(k, buffer):
    def run(batches):
        import pyarrow as pa

        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= buffer:
                left = _cut(pa.concat_tables(held).combine_chunks(), k)
                held, rows = [left], len(left)
                if 2 * rows > buffer:  # a large skyband goes on to the merge as it is
                    yield from left.to_batches()
                    held, rows = [], 0
        if rows:
            yield from _cut(pa.concat_tables(held).combine_chunks(), k).to_batches()
    return run


def skyband_terms(kept, top=TOP, buffer=BUFFER):
    """The rows (lang, source, term, n, lang_n) that can be among the first ``top`` of their group, and few others."""
    schema = "lang string, source string, term string, n long, lang_n long"
    local = kept.select("lang", "source", "term", "n", "lang_n").mapInArrow(_skybands(top, buffer), schema)
    merged = local.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
    return merged.mapInArrow(_skybands(top, buffer), schema)


def distinctive_terms(kept, groups, top=TOP, buffer=BUFFER):
    """(lang, source, item, value, rank): the ``top`` terms whose share in the group exceeds that in the language most."""
    shares = keyed_join(skyband_terms(kept, top, buffer), groups.drop("found", "rest"), ["lang", "source"], "inner").select(
        "lang", "source", F.col("term").alias("item"),
        F.expr(_share("n", "total", "vocabulary")).alias("p"), F.expr(_share("lang_n", "lang_total", "vocabulary")).alias("q"))
    values = shares.filter("p > q").select("lang", "source", "item", F.expr(_divergence("p", "q")).alias("value"))
    return _ranked(values).filter(F.col("rank") <= top)


def _ranked(values):
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return values.withColumn("rank", F.row_number().over(order))


def audit(documents, min_docs=MIN_DOCS, top=TOP, buffer=BUFFER):
    """(lang, source, part, item, value, rank): all pairs of sources, and the first terms of every group."""
    kept, groups = audit_tables(documents, min_docs)
    pairs = _ranked(source_pairs(kept, groups)).withColumn("part", F.lit("pair"))
    terms = distinctive_terms(kept, groups, top, buffer).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def op13_source_divergence(spark, sf_dir):
    return audit(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
tok as (select r, lang, source, unnest(w) as term from d),
voc as (select lang, term, count(*) as n from tok group by all having count(distinct r) >= 3),
sizes as (select lang, count(*)::hugeint as v, sum(n)::hugeint as total from voc group by lang),
grp as (select distinct lang, source from d),
cnt as (select t.lang, t.source, t.term, count(*) as n from tok t semi join voc using (lang, term) group by all),
tot as (select lang, source, sum(n)::hugeint as total from cnt group by all),
p as (
  select g.lang, g.source, voc.term, coalesce(c.n, 0) as n,
         (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + s.v))::hugeint as p,
         (1 + (1000000000::hugeint * (voc.n + 1)) // (s.total + s.v))::hugeint as q
  from grp g join voc using (lang) join sizes s using (lang)
  left join tot t on t.lang = g.lang and t.source = g.source
  left join cnt c on c.lang = g.lang and c.source = g.source and c.term = voc.term),
pairs as (
  select a.lang, a.source, b.source as item,
         coalesce((select sum(((x.p - y.p) * (x.p - y.p)) // y.p) from p x join p y on x.lang = y.lang and x.term = y.term
                   where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
  from grp a join grp b on a.lang = b.lang and a.source <> b.source),
terms as (
  select lang, source, term as item, (((p - q) * (p - q)) // q)::bigint as value from p where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value,
         (row_number() over (partition by lang, source order by value desc, item))::int as rank from pairs
  union all
  select lang, source, 'term', item, value,
         (row_number() over (partition by lang, source order by value desc, item))::int from terms)
select * from ranked where part = 'pair' or rank <= 200
"""
