"""Near-duplicate documents by MinHash: banding, signature verification, exact confirmation, components.

Each text becomes the set of its distinct shingles of ``SHINGLE`` words, hashed to 64 bits; ``HASHES`` universal hash
functions give as many minima, cut into bands of ``ROWS``. Texts of equal sets are one class first, so copies cost one
row. Two sets of similarity 0.75 miss every band of 32 x 4 with probability 5e-6; those more alike far less.

Within a bucket no pairs are listed. Each member is compared with one leader: first with minima (an
estimate, cut 5 standard deviations below the threshold), then on the full sets, with integers. Confirmed links
are joined to components. Members of buckets that still hold several components go on, apart from their buckets, as a prefix join: two
signatures that agree in enough of their minima share one of the rarest of them, so each member looks only under its
rarest minima, and one that all its bucket has, as from a passage that many texts embed, is looked under last or never.
A minimum of up to ``RARE`` members meets them all, so a member has a bounded number of partners however large its bucket is.
Only members that more than ``RARE`` others resemble in most of their minima, such as families of one template, have too few rare ones.
They alone are compared bucket by bucket: dealt into chunks of ``CHUNK``, those outside its largest component visit every chunk of
their bucket, and a task compares the minima of visitors and residents, then the sets of those that pass, and joins as
it goes, so it emits at most one link per member. So every pair that shares a bucket is either in one component or has
been held to the same cut on minima. ``LEADER_ROUNDS`` over 1 tries further leaders first.

Chances of a miss, for a pair at the threshold: 5e-6 that it shares no bucket, 1e-7 that its minima fall below the cut.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing. With fewer words
than a shingle, all words are one shingle. Rows of one doc_id are one node; each row gets its own n_shingles. A row with
a null doc_id takes no part: its component is null and it is kept. An empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import keyed_join, land
from .components import connected_components
from .tokens import shingle_sets, slices

SHINGLE = 5
HASHES = 128
ROWS = 4
PERCENT = 75
LEADER_ROUNDS = 1
CHUNK = 512
RARE = 64  # members that share a minimum and are paired by it

_random = np.random.Generator(np.random.PCG64(19970714))
_A = _random.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, HASHES, dtype=np.uint64)


def signature(shingles):
    """The least value of each hash function, multiply and shift, over a set; uint32."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 1024):
        part = shingles[at:at + 1024]
        low = np.minimum(low, ((part[:, None] * _A + _B) >> np.uint64(32)).astype(np.uint32).min(0))
    return low


def _sketch(shingle):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            sizes, keys, minima = [], [], []
            for s in shingle_sets(batch.column("text"), shingle):
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                minima.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(minima, pa.binary())],
                ["doc_id", "n_shingles", "key", "minima"])
    return run


def _similar(a, b, percent):
    """Whether 100 * intersection >= percent * union, of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent):
    def run(batches):
        for batch in batches:
            ok = [_similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                  for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def _least_equal(percent):
    """Equal minima that a pair at the threshold has but for a chance of about 1e-7."""
    p = percent / 100
    return int(HASHES * p - 5.2 * (HASHES * p * (1 - p)) ** 0.5)


def _plausible(percent):
    """Rows of (u, v) whose minima agree often enough: signature verification."""
    least = _least_equal(percent)

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("ma", "mb"))
            yield batch.select(["u", "v"]).filter(pa.array((a == b).sum(1) >= least, pa.bool_()))
    return run


def _partners(pdf, percent, rows):
    """(visitor, its likely partners among the residents of another component), as places in ``pdf``.

    A pair that meets in several buckets is taken in that of its first band only.
    """
    least, band = _least_equal(percent), int(pdf["band"].iloc[0])
    comp, resident = pdf["comp"].to_numpy(), pdf["resident"].to_numpy()
    minima = np.frombuffer(b"".join(pdf["minima"]), np.uint32).reshape(-1, HASHES)
    home = np.flatnonzero(resident)
    at_home = minima[home]
    for i in np.flatnonzero(~resident):
        equal = at_home == minima[i]
        near = np.flatnonzero((equal.sum(1) >= least) & (comp[home] != comp[i]))
        first = equal[near].reshape(-1, HASHES // rows, rows).all(2).argmax(1)
        yield i, home[near[first == band]]


def _likely_bucket(percent, rows):
    """The members of one chunk of a bucket whose minima agree with those of a member of another component."""
    def run(key, pdf):
        import pandas as pd

        alive = np.zeros(len(pdf), bool)
        for i, near in _partners(pdf, percent, rows):
            alive[near] = True
            alive[i] |= len(near) > 0
        return pd.DataFrame({"bucket": key[0], "rep": pdf["rep"][alive]})
    return run


def _compare_bucket(percent, rows):
    """Links found among the residents and visitors of one chunk of a bucket, at most one per member joined."""
    def run(key, pdf):
        import pandas as pd

        rep, comp = pdf["rep"].to_numpy(), pdf["comp"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in pdf["set"]]
        comp_of = {c: c for c in set(comp)}

        def find(c):
            while comp_of[c] != c:
                c = comp_of[c]
            return c

        links = []
        for i, near in _partners(pdf, percent, rows):
            for j in near:
                a, b = find(comp[i]), find(comp[j])
                if a != b and _similar(sets[i], sets[j], percent):
                    comp_of[max(a, b)] = min(a, b)
                    links.append((rep[i], rep[j]))
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")
    return run


def _with_components(members, links):
    """``members`` with ``comp`` from the links so far; a set without a link is a component of its own."""
    comps = land(connected_components(links)).select(F.col("node").alias("rep"), "component")
    return keyed_join(members, comps, ["rep"]).withColumn("comp", F.coalesce("component", "rep")).drop("component")


def _verified(pairs, minima, sketches, texts, percent, shingle):
    """The (u, v) of ``pairs`` whose sets reach the threshold; ``minima`` is (rep, minima) of at least their members."""
    both = keyed_join(pairs.withColumn("rep", F.col("u")), minima, ["rep"], "inner").withColumnRenamed("minima", "ma")
    both = keyed_join(both.withColumn("rep", F.col("v")), minima, ["rep"], "inner").withColumnRenamed("minima", "mb")
    likely = land(both.select("u", "v", "ma", "mb").mapInArrow(_plausible(percent), "u long, v long"))
    sets = _sets_of(likely.select(F.explode(F.array("u", "v")).alias("rep")).distinct(), sketches, texts, shingle)
    # Every set has a row here, and sets are large, so they are shuffled at every size.
    whole = keyed_join(likely.withColumn("rep", F.col("u")), sets, ["rep"], "inner", measured=False).withColumnRenamed("set", "a")
    whole = keyed_join(whole.withColumn("rep", F.col("v")), sets, ["rep"], "inner", measured=False).withColumnRenamed("set", "b")
    return land(whole.select("u", "v", "a", "b").mapInArrow(_confirm(percent), "u long, v long"))


def _sets_of(reps, sketches, texts, shingle):
    """(rep, set) of the wanted sets, from the text of the least document that has each."""
    wanted = land(sketches.select("rep", "doc_id", F.col("key").alias("_key")).join(reps, "rep", "left_semi"))
    rows = keyed_join(texts, wanted, ["doc_id"], "inner")

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            found = [(s.tobytes(), len(s) and hashlib.blake2b(s.tobytes(), digest_size=16).digest() == k)
                     for s, k in zip(shingle_sets(batch.column("text"), shingle), batch.column("_key").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([f[0] for f in found], pa.binary())], ["rep", "set"]).filter(
                pa.array([bool(f[1]) for f in found], pa.bool_()))

    return land(rows.select("rep", "text", "_key").mapInArrow(run, "rep long, set binary").dropDuplicates(["rep"]))


def near_links(sketches, texts, percent=PERCENT, shingle=SHINGLE, rows=ROWS, chunk=CHUNK, rare=RARE):
    """(u, v) links that join all similar sets of ``sketches``, one row (rep, key, doc_id, minima) per distinct set."""
    width = 4 * rows
    bands = F.transform(F.sequence(F.lit(0), F.lit(HASHES // rows - 1)), lambda b: F.xxhash64(
        b, F.substring("minima", b * width + 1, F.lit(width))))
    placed = sketches.select("rep", F.posexplode(bands).alias("band", "bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("leader")).filter("n > 1")
    members = land(placed.join(shared, "bucket"))
    minima = sketches.select("rep", "minima")
    links = None
    for turn in range(LEADER_ROUNDS):
        if links is None:
            pairs = members.select(F.col("rep").alias("u"), F.col("leader").alias("v"))
        else:
            apart = _unsettled(_with_components(members, links))
            if not apart.limit(1).count():
                return links
            pick = F.min(F.struct(F.xxhash64("bucket", "rep", F.lit(turn)), "rep", "comp"))
            leaders = apart.groupBy("bucket").agg(pick.alias("by")).select(
                "bucket", F.col("by.rep").alias("v"), F.col("by.comp").alias("v_comp"))
            pairs = apart.drop("leader").join(leaders, "bucket").filter("comp != v_comp").select(F.col("rep").alias("u"), "v")
        pairs = pairs.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        found = _verified(land(pairs), minima, sketches, texts, percent, shingle)
        links = found if links is None else land(links.unionByName(found))
    apart = _unsettled(_with_components(members, links))
    if not apart.limit(1).count():
        return links
    unsettled = land(apart.select("rep", "comp").distinct().join(minima, "rep"))
    pairs, alike = _prefix_pairs(unsettled, _least_equal(percent), rare)
    links = land(links.unionByName(_verified(pairs, unsettled.drop("comp"), sketches, texts, percent, shingle)))
    if not alike.limit(1).count():
        return links
    apart = members.join(alike, "rep", "left_semi").drop("n", "leader")
    apart = _unsettled(_with_components(apart, links))
    if not apart.limit(1).count():
        return links
    met = _meetings(apart, chunk).join(minima, "rep").groupBy("bucket", "chunk", "part").applyInPandas(_likely_bucket(percent, rows), "bucket long, rep long")
    alive = land(apart.join(met.distinct(), ["bucket", "rep"], "left_semi"))
    if not alive.limit(1).count():
        return links
    sets = _sets_of(alive.select("rep").distinct(), sketches, texts, shingle)
    rows_ = _meetings(alive, chunk).join(minima, "rep").join(sets, "rep")
    more = rows_.groupBy("bucket", "chunk", "part").applyInPandas(_compare_bucket(percent, rows), "u long, v long")
    return land(links.unionByName(more.distinct()))


def _prefix_pairs(members, least, rare):
    """((u, v), reps): pairs of different components that share one of their rarest minima, and the members with too few rare ones.

    ``members`` is (rep, comp, minima). Signatures that agree in ``least`` minima share one among the HASHES - least + 1 that come
    first in any order of all minima, so in that from rare to common too. A minimum that no other member has fills a
    place and meets nobody.
    """
    prefix = HASHES - least + 1
    minimum = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.xxhash64(i, F.substring("minima", i * 4 + 1, F.lit(4))))
    minima = land(members.select("rep", F.explode(minimum).alias("minimum")))
    shared = minima.groupBy("minimum").agg(F.count("*").alias("n")).filter("n > 1")
    own = minima.join(shared, "minimum").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("n", "minimum"))).alias("shared"))
    first = own.select("rep", F.slice("shared", F.lit(1), F.greatest(F.lit(prefix - HASHES) + F.size("shared"), F.lit(0))).alias("first"))
    first = land(first.filter(F.size("first") > 0).join(members.select("rep", "comp"), "rep"))
    looks = land(first.select("rep", "comp", F.inline("first")))
    scarce, common = looks.filter(F.col("n") <= rare).drop("n"), looks.filter(F.col("n") > rare)
    other = scarce.select(F.col("rep").alias("v"), F.col("comp").alias("v_comp"), "minimum")
    pairs = scarce.withColumnRenamed("rep", "u").join(other.hint("merge"), "minimum").filter("u > v and comp != v_comp").select("u", "v").distinct()
    # A common minimum matters only where members of several components look under it.
    mixed = common.groupBy("minimum").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("minimum")
    return land(pairs), land(common.join(mixed, "minimum", "left_semi").select("rep").distinct())


def _meetings(apart, chunk):
    """(bucket, chunk, part, band, rep, comp, resident): every member at home in one chunk of its bucket and, unless it is
    of the component that most of the bucket belongs to, a visitor in all of them; visitors are dealt into parts likewise."""
    sizes = apart.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
    shape = sizes.groupBy("bucket").agg(
        F.max_by("comp", F.struct("size", "comp")).alias("main"), F.ceil(F.sum("size") / chunk).cast("int").alias("chunks"),
        F.ceil((F.sum("size") - F.max("size")) / chunk).cast("int").alias("parts"))
    known = land(apart.join(shape, "bucket").withColumn("visits", F.col("comp") != F.col("main")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    homes = known.select("bucket", own("chunks").alias("chunk"), every("parts").alias("part"), "band", "rep", "comp", F.lit(True).alias("resident"))
    visits = known.filter("visits").select(
        "bucket", every("chunks").alias("chunk"), own("parts").alias("part"), "band", "rep", "comp", F.lit(False).alias("resident"))
    return homes.unionByName(visits)


def _unsettled(members):
    """The members of the buckets that hold several components."""
    mixed = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("bucket")
    return land(members.join(mixed, "bucket", "left_semi"))


def near_duplicates(documents, percent=PERCENT, shingle=SHINGLE, rows=ROWS, chunk=CHUNK, rare=RARE):
    """(doc_id, n_shingles, component_id, kept), one row per row of ``documents``."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = land(texts.mapInArrow(_sketch(shingle), "doc_id long, n_shingles long, key binary, minima binary"))
    nodes = sketched.filter("doc_id is not null and key is not null")
    least = nodes.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    # A doc_id may have several sets, so sets have numbers of their own; written once, they stay as they are.
    firsts = land(nodes.groupBy("key").agg(F.min(F.struct("doc_id", "minima")).alias("f")).select(
        "key", "f.doc_id", "f.minima", F.monotonically_increasing_id().alias("rep")))
    links = near_links(firsts, texts, percent, shingle, rows, chunk, rare)
    ids = firsts.select("rep", "doc_id")
    linked = links.join(ids.select(F.col("rep").alias("u"), F.col("doc_id").alias("a")), "u").join(
        ids.select(F.col("rep").alias("v"), F.col("doc_id").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    same = keyed_join(nodes.select("key", "doc_id"), least.filter("copies > 1"), ["key"], "inner")
    edges = same.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).unionByName(linked)
    comps = land(connected_components(edges)).select(F.col("node").alias("doc_id"), "component")
    out = keyed_join(sketched.select("doc_id", "n_shingles"), comps, ["doc_id"])
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op1_minhash_dedup(spark, sf_dir):
    from .common import read_table

    return near_duplicates(read_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
with recursive d as (
  select distinct doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as sh from d),
n as (select doc_id, count(*) as n from s group by doc_id),
both_ as (select a.doc_id as u, b.doc_id as v, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select u, v from both_ join n a on u = a.doc_id join n b on v = b.doc_id where 100 * c >= 75 * (a.n + b.n - c)),
reach as (select doc_id as x, doc_id as y from n union select x, v from reach join links on y = u),
comp as (select x, min(y) as c from reach group by x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.c, d.doc_id) as component_id,
       coalesce(c.c, d.doc_id) = d.doc_id as kept
from documents d left join n on n.doc_id = d.doc_id left join comp c on c.x = d.doc_id
"""
