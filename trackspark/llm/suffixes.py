"""Removal of long repeated byte strings by suffix arrays built in two stages.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the corpus. With a lesser ``floor``, strings
of so many bytes are found on the way: their bytes are counted as repeated, so that shorter copied passages show, but stay. Three steps:

1. Candidates. Of the grams of ``GRAM`` bytes in each string of ``floor`` bytes the one of least hash is kept, so two equal strings keep the same
   gram at the same place. Consecutive starts that keep one gram form a run; the run's bytes, from its first start to ``LENGTH`` bytes after its
   last, or to the text's end, are its context. Runs whose gram occurs once are done. Runs with equal gram and context are copies of each
   other, wholly repeated, and only counted, so a group of copies costs one row per text and is counted before the shuffle.
2. Suffix arrays. The different contexts of a gram are gathered, gram by gram, in bundles of bounded size. A bundle is sorted as
   one text in two stages: only suffixes smaller than their successors are sorted directly (as sequences of the
   segments between two such places, by doubling); all others are induced by scanning the buckets of first bytes in order. Common
   prefixes of neighbours in the array then tell which starts are repeated, for ``floor`` bytes or for ``LENGTH``.
3. The contexts of a gram that has over ``MOST`` different ones, such as that of a passage that very many documents embed, are cut again by a
   gram three times as long, one context of each group of copies only. Steps 1 and 2 are repeated on these runs, which are fewer to a
   gram each time. A gram as long as the string itself makes a run of every start, so that all runs of one gram are copies; there the work ends.

Matches never cross documents: texts, contexts and runs end with their document.

Defined cases: null and empty texts have no bytes and nothing removed; texts shorter than ``LENGTH`` lose nothing. Rows of equal text
are separate documents, so each is a copy of the other. Null or repeated doc_ids do not matter. An empty table gives no rows.
Spans are counted after merging those that touch or overlap.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import keyed_join, land, text_key
from .tokens import _BASE, _INVERSE, _power, mix, text_bytes

LENGTH = 400
GRAM = 64
MOST = 1_000  # contexts of one gram that are gathered in one bundle; those of a more common gram are cut by a longer one
LONGER = 3
BUNDLE = 1 << 20  # bytes of contexts in a bundle, about
PIECE = 2 << 20
_PLAIN, _OTHER = np.random.Generator(np.random.PCG64(4)).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OTHER_BASE = _BASE ^ 0x5555555555555554
_OTHER_INVERSE = pow(_OTHER_BASE, -1, 1 << 64)


def _window_hash(sums, starts, ends, inverse=_INVERSE):
    return (sums[ends] - sums[starts]) * _power(inverse, len(sums))[starts]


def _sums(data, values=_PLAIN, base=_BASE):
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * _power(base, len(data)), out=sums[1:])
    return sums


def _first_least(values, width):
    """For each window of ``width`` values the place of the least one, the first of equals."""
    n = len(values)
    keys = (values & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)
    full = -(-n // width) * width
    blocks = np.full(full, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(behind[:m], ahead[width - 1:width - 1 + m]) & np.uint64(0xFFFFFF)).astype(np.int64)


def runs_of(data, bounds, owned, length, floor, gram):
    """(document, first, last, end, print, context) of the runs in one piece of texts; places count from the piece's start.

    Starts from ``owned`` on belong to the next piece. The context's hash is independent of the gram's, so that both together have 128 bits
    where they cover the same bytes.
    """
    empty = np.empty(0, np.int64)
    if len(data) < floor:
        return (empty,) * 6
    sums = _sums(data)
    at = np.arange(len(data) - gram + 1)
    grams = mix(_window_hash(sums, at, at + gram))
    place = _first_least(grams, floor - gram + 1)
    starts = np.arange(len(place))
    document = np.searchsorted(bounds, starts, side="right") - 1
    ok = (starts + floor <= bounds[document + 1]) & (starts < owned)
    starts, place, document = starts[ok], place[ok], document[ok]
    if not len(starts):
        return (empty,) * 6
    new = np.flatnonzero((np.diff(place) != 0) | (np.diff(document) != 0)) + 1
    heads, tails = np.append(0, new), np.append(new, len(starts)) - 1
    first, last, place, document = starts[heads], starts[tails], place[heads], document[heads]
    end = np.minimum(last + length, bounds[document + 1])
    shape = (last - first).astype(np.uint64) << np.uint64(40) | (place - first).astype(np.uint64) << np.uint64(20) | (end - first).astype(np.uint64)
    context = mix(_window_hash(_sums(data, _OTHER, _OTHER_BASE), first, end, _OTHER_INVERSE) ^ mix(shape))
    return document, first, last, end, grams[place].view(np.int64), context.view(np.int64)


def _merge(lo, hi):
    """Sorted, merged [lo, hi) spans; touching ones join."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.append(True, lo[1:] > hi[:-1])
    return lo[new], hi[np.append(new[1:], True)]


def _pieces(offsets, length):
    """Cuts of a batch: (first document, last document, from, to, starts owned); a long text is cut with an overlap of ``length`` - 1 bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1, i + 1)
        if j == i + 1 and offsets[j] - offsets[i] > PIECE:
            for a in range(offsets[i], offsets[j], PIECE):
                yield i, j, a, min(a + PIECE + length - 1, offsets[j]), PIECE
        else:
            yield i, j, offsets[i], offsets[j], offsets[j] - offsets[i]
        i = j


def _find_runs(length, floor, gram):
    """Rows (key, print, context, lo, hi, end, n): a run, with n equal ones in its text; or a span of the text that is
    repeated within it, without a print and with the length of its strings as n."""
    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            keys = batch.column("key")
            for i, j, a, b, owned in _pieces(offsets, length):
                bounds = np.clip(offsets[i:j + 1], a, b) - a
                doc, lo, hi, end, print_, context = runs_of(data[a:b], bounds, owned, length, floor, gram)
                base = a - offsets[i + doc]
                frame = pd.DataFrame({"doc": doc + i, "print": print_, "context": context, "lo": lo + base, "hi": hi + base, "end": end + base})
                twice = frame.duplicated(["doc", "print", "context"], keep=False)
                same = frame[twice]
                frame["n"] = 1
                if len(same):
                    firsts = same.groupby(["doc", "print", "context"], as_index=False).agg(
                        lo=("lo", "min"), hi=("hi", "min"), end=("end", "min"), n=("lo", "size"))
                    frame = pd.concat([frame[~twice], firsts], ignore_index=True)
                yield _rows(keys, frame, False)
                spans = []
                for d, g in same.groupby("doc"):
                    for kind in {floor, length}:
                        lo, hi = g["lo"].to_numpy(), np.minimum(g["hi"].to_numpy() + kind, g["end"].to_numpy())
                        whole = hi - lo >= kind
                        if whole.any():
                            x, y = _merge(lo[whole], hi[whole])
                            spans.append(pd.DataFrame({"doc": d, "print": 0, "context": 0, "lo": x, "hi": y, "end": y, "n": kind}))
                if spans:
                    yield _rows(keys, pd.concat(spans, ignore_index=True), True)
    return run


_RUN = "key binary, print long, context long, lo long, hi long, end long, n long"
_SPAN = "key binary, lo long, hi long, kind int"
_CUT = "print long, context long, key binary, lo long, width long, bytes binary"


def _rows(keys, frame, spans):
    column = lambda c: pa.array(frame[c].to_numpy(np.int64))
    prints = pa.nulls(len(frame), pa.int64()) if spans else column("print")
    return pa.RecordBatch.from_arrays(
        [keys.take(column("doc")), prints, *(column(c) for c in ("context", "lo", "hi", "end", "n"))],
        ["key", "print", "context", "lo", "hi", "end", "n"])


def _rank(keys):
    """Dense ranks of the values, and how many there are."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    steps = np.append(0, np.cumsum(sorted_[1:] != sorted_[:-1]))
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = steps
    return ranks, int(steps[-1]) + 1 if len(keys) else 0


def suffix_array(symbols, depth):
    """Start places of all suffixes of ``symbols`` (uint16 below 512), sorted by at least their first ``depth`` symbols."""
    n = len(symbols)
    s = symbols.astype(np.int64)
    # A suffix is small if it is less than its successor: the next different symbol is greater.
    change = np.flatnonzero(s[1:] != s[:-1]) + 1
    nearest = np.append(change, n)[np.searchsorted(change, np.arange(n), side="right")]
    small = np.zeros(n, bool)
    inner = nearest < n
    small[inner] = s[nearest[inner]] > s[inner]
    places = np.flatnonzero(small)
    # Direct sort of the small suffixes: names of the segments up to the next small place, then doubling.
    marked = np.zeros(n + 8, np.int64)
    marked[:n] = s * 2 + small
    ends = np.append(places[1:], n - 1) if len(places) else places
    ranks, known = np.zeros(len(places), np.int64), 1
    longest = int((ends - places).max()) + 1 if len(places) else 0
    live = np.arange(len(places))
    for d in range(0, longest, 6):
        key = np.zeros(len(live), np.int64)
        for k in range(6):
            at = places[live] + d + k
            key = key * 1024 + np.where(at <= ends[live], marked[np.minimum(at, n)] + 1, 0)
        sub, _ = _rank(key)
        pair = ranks * (len(live) + 1)
        pair[live] += sub
        ranks, known = _rank(pair)
        size = np.bincount(ranks, minlength=known)
        live = np.flatnonzero((size[ranks] > 1) & (ends - places >= d + 6))
        if not len(live):
            break
    reach = 1
    while known < len(places) and reach < depth:
        after = np.zeros(len(places), np.int64)
        after[:-reach or None] = ranks[reach:] + 1
        ranks, known = _rank(ranks * (known + 2) + after)
        reach *= 2
    order = places[np.argsort(ranks, kind="stable")]
    # Induction: scan the buckets of first symbols in order; each suffix places its larger predecessor.
    small_of = np.split(order, np.searchsorted(s[order], np.arange(1, 512)))
    waiting = [[] for _ in range(512)]
    if n:
        waiting[s[n - 1]].append(np.array([n - 1]) if not small[n - 1] else np.empty(0, np.int64))
    out = []
    for c in range(512):
        large = waiting[c]
        front = np.concatenate(large) if large else np.empty(0, np.int64)
        parts = [front]
        while len(front):
            front = front[front > 0] - 1
            front = front[(s[front] == c) & ~small[front]]
            parts.append(front)
        bucket = np.concatenate([*parts, small_of[c]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & (s[before] > c)]
        if len(before):
            first = s[before].astype(np.uint16)
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, cuts):
                waiting[s[part[0]]].append(part)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _prefixes_meet(order, eight, length):
    """Places of which a neighbour in ``order`` shares the first ``length`` symbols, compared eight by eight."""
    left, right = order[:-1], order[1:]
    same = np.arange(len(left))
    for d in [*range(0, length - 7, 8), length - 8]:
        same = same[eight[left[same] + d] == eight[right[same] + d]]
    return np.concatenate([left[same], right[same]])


def repeated_starts(contexts, widths, lengths):
    """For each of ``lengths``, and each context, a mask of its first ``widths`` starts: whether so many bytes from there occur elsewhere too."""
    sizes = np.array([len(c) for c in contexts])
    begin = np.append(0, np.cumsum(sizes + 1))[:-1]
    symbols = np.zeros(int(sizes.sum()) + len(contexts), np.uint16)
    for c, a in zip(contexts, begin, strict=True):
        symbols[a:a + len(c)] = np.frombuffer(c, np.uint8).astype(np.uint16) + 1
    room = np.zeros(len(symbols), np.int64)  # bytes from a start to the end of its context
    for a, w, n in zip(begin, widths, sizes, strict=True):
        room[a:a + w] = n - np.arange(w)
    order = suffix_array(symbols, max(lengths))
    eight = np.zeros(len(symbols), np.uint64)  # eight bytes from each place; separators are in no compared string
    low = np.append(symbols, np.zeros(8, np.uint16)).astype(np.uint64)
    for k in range(8):
        eight |= (low[k:k + len(symbols)] & np.uint64(0xFF)) << np.uint64(8 * k)
    out = []
    for length in lengths:
        hit = np.zeros(len(symbols), bool)
        hit[_prefixes_meet(order[room[order] >= length], eight, length)] = True
        out.append([hit[a:a + w] for a, w in zip(begin, widths, strict=True)])
    return out


def _sort_bundle(lengths):
    def run(pdf):
        contexts = [bytes(b) for b in pdf["bytes"]]
        out = []
        for kind, masks in zip(lengths, repeated_starts(contexts, list(pdf["width"]), lengths), strict=True):
            for key, lo, mask in zip(pdf["key"], pdf["lo"], masks, strict=True):
                at = np.flatnonzero(mask)
                if len(at):
                    out += [(key, a + lo, b + lo, kind) for a, b in zip(*_merge(at, at + kind), strict=True)]
        keys, lows, highs, kinds = zip(*out, strict=True) if out else ((),) * 4
        return pd.DataFrame({"key": list(keys), "lo": np.array(lows, np.int64), "hi": np.array(highs, np.int64), "kind": np.array(kinds, np.int32)})
    return run


def _cut_contexts(batches):
    """(print, common, key, lo, width, bytes) of the wanted runs of each text."""
    for batch in batches:
        out = {"print": [], "common": [], "key": [], "lo": [], "width": [], "bytes": []}
        for key, text, runs in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "runs")), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for r in runs:
                out["print"].append(r["print"])
                out["common"].append(r["common"])
                out["key"].append(key)
                out["lo"].append(r["lo"])
                out["width"].append(r["hi"] - r["lo"] + 1)
                out["bytes"].append(data[r["lo"]:r["end"]])
        kinds = {"common": pa.bool_(), "key": pa.binary(), "bytes": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))


def _cut_again(kind, gram):
    """(print, context, key, lo, width, bytes) of the runs of ``gram`` within contexts; bytes are left out where every run is one string."""
    def run(batches):
        for batch in batches:
            parts, keys, lows = batch.column("bytes").to_pylist(), batch.column("key"), batch.column("lo").to_numpy()
            data = np.frombuffer(b"".join(parts), np.uint8)
            offsets = np.append(0, np.cumsum([len(part) for part in parts], dtype=np.int64))
            for i, j, a, b, owned in _pieces(offsets, kind):
                bounds = np.clip(offsets[i:j + 1], a, b) - a
                doc, first, last, end, print_, context = runs_of(data[a:b], bounds, owned, kind, kind, gram)
                own = [] if gram == kind else [data[a + x:a + y].tobytes() for x, y in zip(first, end, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(print_), pa.array(context), keys.take(pa.array(doc + i)), pa.array(first + a - offsets[i + doc] + lows[i + doc]),
                     pa.array(last - first + 1), pa.array(own, pa.binary()) if own else pa.nulls(len(doc), pa.binary())],
                    ["print", "context", "key", "lo", "width", "bytes"])
    return run


def _sorted_spans(contexts, size, lengths, bundle):
    """Repeated spans of contexts (print, key, lo, width, bytes) of ``size`` bytes in all, those of one gram side by side in a bundle."""
    bundles = max(1, -(-size // bundle))
    return contexts.groupBy(F.pmod(F.xxhash64("print"), F.lit(bundles)).alias("bundle")).applyInPandas(_sort_bundle(lengths), _SPAN)


def _spans_by_longer_grams(contexts, kind, gram, most, bundle):
    """Repeated spans among contexts (key, lo, width, bytes) whose gram is too common to gather them, as a list of tables."""
    found = []
    contexts = contexts.withColumn("bytes", F.expr(f"substring(bytes, 1, width + {kind - 1})"))
    while gram < kind and contexts.limit(1).count():
        gram = min(LONGER * gram, kind)
        runs = land(contexts.mapInArrow(_cut_again(kind, gram), _CUT))
        groups = land(runs.groupBy("print", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "lo", "width", "bytes")).alias("at")))
        copies = groups.filter("n > 1").select("print", "context")
        found.append(runs.join(copies.hint("merge"), ["print", "context"]).select(
            "key", "lo", (F.col("lo") + F.col("width") + (kind - 1)).alias("hi"), F.lit(kind).alias("kind")))
        shared = groups.groupBy("print").agg(F.count("*").alias("contexts")).filter("contexts > 1")
        mixed = land(groups.join(shared.hint("merge"), "print").select("print", "contexts", "at.*"))
        if gram < kind:
            few = mixed.filter(F.col("contexts") <= most)
            found.append(_sorted_spans(few, few.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0, [kind], bundle))
        contexts = mixed.filter(F.col("contexts") > most).select("key", "lo", "width", "bytes")
    return found


def repeated_spans(texts, length=LENGTH, floor=LENGTH, gram=GRAM, most=MOST, bundle=BUNDLE):
    """(key, lo, hi, kind): spans of the rows (key, text) whose strings of ``kind`` bytes, ``floor`` or ``length``, are repeated; not merged."""
    lengths = sorted({floor, length})
    runs = land(texts.mapInArrow(_find_runs(length, floor, gram), _RUN))
    spans = runs.filter("print is null").select("key", "lo", "hi", F.col("n").cast("int").alias("kind"))
    runs = runs.filter("print is not null")
    # Most grams occur once. Their runs go first, so that the joins and counts below move the others only.
    often = runs.groupBy("print").agg(F.sum("n").alias("total")).filter("total > 1")
    runs = land(runs.join(often.hint("merge"), "print", "left_semi"))
    groups = runs.groupBy("print", "context").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "lo", "hi", "end")).alias("at"))
    groups = land(groups.groupBy("print").agg(F.count("*").alias("contexts")).join(groups.hint("merge"), "print"))
    copies = groups.filter("n > 1").select("print", "context")
    # Copies and contexts grow with the corpus, so these joins shuffle at every size.
    each = F.array(*(F.struct("lo", F.least(F.col("hi") + kind, "end").alias("hi"), F.lit(kind).alias("kind")) for kind in lengths))
    copied = runs.join(copies.hint("merge"), ["print", "context"]).select("key", F.inline(each)).filter("hi - lo >= kind")
    mixed = groups.filter("contexts > 1").select("print", (F.col("contexts") > most).alias("common"), "at.*")
    per_text = mixed.groupBy("key").agg(F.collect_list(F.struct("print", "common", "lo", "hi", "end")).alias("runs"))
    # One row per text: rows of equal text have one key, and meet before they are shuffled. Texts move once, for all contexts.
    contexts = land(texts.dropDuplicates(["key"]).join(per_text.hint("merge"), "key").select("key", "text", "runs").mapInArrow(
        _cut_contexts, "print long, common boolean, key binary, lo long, width long, bytes binary"))
    size = mixed.filter("not common").agg(F.sum(F.col("end") - F.col("lo"))).first()[0] or 0
    few = contexts.filter("not common").drop("common")
    out = spans.unionByName(copied).unionByName(_sorted_spans(few, size, lengths, bundle))
    common = contexts.filter("common").drop("print", "common")
    if common.limit(1).count():
        for kind in lengths:
            for more in _spans_by_longer_grams(common, kind, gram, most, bundle):
                out = out.unionByName(more)
    return land(out)


def _remove(length):
    def run(batches):
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "n_repeated": []}
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                lo, hi, repeated = np.empty(0, np.int64), np.empty(0, np.int64), 0
                kept = data
                if spans:
                    every = np.array([(x["lo"], x["hi"], x["kind"]) for x in spans], np.int64).T
                    a, b = _merge(every[0], every[1])
                    repeated = int((b - a).sum())
                    long_ones = every[:, every[2] == length]
                    if long_ones.size:
                        lo, hi = _merge(long_ones[0], long_ones[1])
                        kept = b"".join(data[a:b] for a, b in zip([0, *hi], [*lo, len(data)], strict=True))
                for name, value in zip(out, (len(data), int((hi - lo).sum()), len(lo), kept, repeated), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, pa.binary() if k == "kept" else pa.int64()) for k, v in out.items())], ["doc_id", *out])
    return run


def remove_repeats(documents, length=LENGTH, gram=GRAM, most=MOST, bundle=BUNDLE, floor=LENGTH):
    """(doc_id, n_bytes, n_removed, n_spans, kept, n_repeated): ``kept`` holds the remaining bytes, ``n_repeated`` counts those in repeats of ``floor`` bytes."""
    floor = min(floor, length)
    texts = documents.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    whole = texts.filter(F.octet_length("text") >= floor).select("key", "text")
    spans = repeated_spans(whole, length, floor, gram, most, bundle).distinct()
    per_text = land(spans.groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "kind")).alias("spans")))
    kind = documents.schema["doc_id"].dataType.simpleString()
    # Texts with spans grow with the corpus too.
    return keyed_join(texts, per_text, ["key"], measured=False).select("doc_id", "text", "spans").mapInArrow(
        _remove(length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, n_repeated long")


def op4_suffix_dedup(spark, sf_dir):
    from .common import read_table

    return remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
