"""Language-model scores: Katz backoff with Good-Turing discounts.

A bigram model over words and one end token per text. Counts up to ``K`` are discounted by Good-Turing; what a context loses goes
to the words not seen after it, in proportion to the unigram model, with a backoff weight that makes the
probabilities of each context sum to exactly one. The unigram model is discounted likewise, and its loss is the
probability of the one unknown word. A context without a count of up to ``K`` keeps 1 / (total + 1) for backing off.

Texts are packed once into compressed blocks of about ``BLOCK`` bytes and landed. What a block needs of the model, its distinct
words and bigrams, goes to the partition of the word, or of the context's hash, together with the block's training counts;
there the counts of all blocks are added up, kept as tables by partition, and answered to each block in the order it asked.
So a text's n-grams are shuffled once per block, not once per occurrence; no task holds more than its
share of the keys, and a word or context held by a third of the corpus is one entry per block. Blocks then evaluate
each token recursively: the bigram if it was seen, else the backoff weight times the unigram, else the unknown word.

Words are known by 64-bit hash, and within a partition by 48 bits of it.

Defined cases: a null text is empty and has its end token only. Rows with a null id are learned from nowhere and not held
out. Repeated rows each count and get a row. Without training rows every word is unknown with probability 1 and score 0, and the
base score is that of empty counts. An empty table gives no rows. Other columns are not read.
"""

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
import zstandard
from pyspark.sql import functions as F

from .common import land, read_table
from .tokens import word_hashes

K = 5
BLOCK = 8 << 20
PART = 12 << 20  # bytes of text behind one partition of the tables
FOLDS = 10
START, STOP = np.uint64(0x5354415254), np.uint64(0x53544F50)
_MASK = np.uint64((1 << 48) - 1)


def squeeze(values):
    """Bytes of an array, byte planes together, compressed."""
    values = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data, dtype):
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


# Blocks of texts ------------------------------------------------------------------------------------------------

_BLOCK = "block string, doc_ids array<bigint>, trains array<boolean>, held array<boolean>, texts binary"


def _pack(limit):
    def block_of(batch):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))
        sink = pa.BufferOutputStream()
        texts = pa.RecordBatch.from_arrays([batch.column("text")], ["text"])
        with pa.ipc.new_stream(sink, texts.schema, options=options) as writer:
            writer.write_batch(texts)
        lists = [pa.array([batch.column(c).to_pylist()], t) for c, t in (
            ("doc_id", pa.list_(pa.int64())), ("trains", pa.list_(pa.bool_())), ("held_out", pa.list_(pa.bool_())))]
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), *lists, pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["block", "doc_ids", "trains", "held", "texts"])

    def run(batches):
        waiting, size = [], 0

        def flush():
            table = pa.Table.from_batches(waiting).combine_chunks()
            return block_of(table.to_batches()[0])

        for batch in batches:
            lengths = np.array(pc.fill_null(pc.binary_length(batch.column("text")), 0))
            begin = 0
            for i, n in enumerate(lengths):
                if size + n > limit and (size or i > begin):
                    waiting.append(batch.slice(begin, i - begin))
                    yield flush()
                    waiting, size, begin = [], 0, i
                size += int(n)
            if begin < len(lengths):
                waiting.append(batch.slice(begin))
        if sum(map(len, waiting)):
            yield flush()
    return run


class Block:
    """The tokens of a block: distinct words, and each token's place among them."""

    def __init__(self, texts):
        column = pa.ipc.open_stream(texts).read_all().column("text")
        words, bounds = word_hashes(column)
        n = np.diff(bounds)
        self.ends = np.cumsum(n + 1)  # one end token after each text
        self.begins = self.ends - n - 1
        tokens = np.empty(len(words) + len(n), np.uint64)
        stop = np.zeros(len(tokens), bool)
        stop[self.ends - 1] = True
        tokens[stop], tokens[~stop] = STOP, words
        self.words, self.at = np.unique(tokens, return_inverse=True)
        self.lengths = n + 1

    def trained(self, trains):
        return np.repeat(np.array([bool(t) for t in trains]), self.lengths)

    def parts(self, of):
        return ((self.words >> np.uint64(48)) % np.uint64(of)).astype(np.int64)

    def bigrams(self):
        """(contexts, where, words, inverse): distinct pairs as places; the context past the last word is the start."""
        before = np.empty(len(self.at), np.int64)
        before[1:] = self.at[:-1]
        before[self.begins] = len(self.words)
        code, inverse = np.unique(before * (len(self.words) + 1) + self.at, return_inverse=True)
        return code // (len(self.words) + 1), code % (len(self.words) + 1), inverse


# Unigrams -------------------------------------------------------------------------------------------------------

def _ask_words(parts):
    def run(batches):
        for batch in batches:
            for name, trains, texts in zip(*(batch.column(c).to_pylist() for c in ("block", "trains", "texts")), strict=True):
                block = Block(texts)
                counts = np.bincount(block.at, weights=block.trained(trains), minlength=len(block.words)).astype(np.int32)
                part = block.parts(parts)
                rows = [(p, name, block.words[part == p].tobytes(), squeeze(counts[part == p])) for p in range(parts) if (part == p).any()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)],
                    ["part", "block", "words", "counts"])
    return run


_ANSWER = "part int, block string, counts binary, totals binary, sums binary, keys binary, stats array<bigint>"


def _answer(rows):
    return pd.DataFrame(rows, columns=["part", "block", "counts", "totals", "sums", "keys", "stats"])


def _stats(counts):
    """Number of entries, of occurrences, and of entries that occur 1, 2, .. K + 1 times."""
    counts = counts[counts > 0]
    return [len(counts), int(counts.sum()), *np.bincount(counts[counts <= K + 1], minlength=K + 2)[1:].tolist()]


def _count_words(pdf):
    part = int(pdf["part"].iloc[0])
    words = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
    keys, inverse = np.unique(np.concatenate(words), return_inverse=True)
    counts = np.bincount(inverse, weights=np.concatenate([unsqueeze(c, np.int32) for c in pdf["counts"]])).astype(np.int64)
    cuts = np.cumsum([len(w) for w in words])[:-1]
    rows = [(part, b, squeeze(counts[i]), None, None, None, None) for b, i in zip(pdf["block"], np.split(inverse, cuts), strict=True)]
    rows.append((part, None, squeeze(counts), None, None, keys.tobytes(), _stats(counts)))  # the table of this partition
    return _answer(rows)


def _word_counts(block, answers, parts):
    """The corpus counts of a block's words, from the answers of all partitions."""
    part, out = block.parts(parts), np.zeros(len(block.words), np.int64)
    for p, counts in zip(answers["part"], answers["counts"], strict=True):
        out[part == p] = unsqueeze(counts, np.int64)
    return out


class Discounts:
    """Good-Turing discount factors of counts 1 to K from the numbers of entries by count."""

    def __init__(self, stats):
        self.types, self.tokens, n = stats[0], stats[1], [0, *stats[2:]]
        self.factors = np.ones(K + 1)
        last = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        for r in range(1, K + 1):
            d = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last) if n[r] and last < 1 else -1.0
            self.factors[r] = d if 0 < d < 1 else (r - 0.5) / r  # where the counts of counts are too thin to tell

    def __call__(self, counts):
        return np.where(counts <= K, self.factors[np.minimum(counts, K)], 1.0)

    def unigrams(self):
        """(scale, unknown): what seen words are multiplied by and the unknown word gets."""
        return self.scale, self.unknown

    def close(self, mass):
        """``mass``: what the discounted words keep of the whole."""
        if self.tokens and 1 - mass < 1e-12:
            self.scale = self.tokens / (self.tokens + 1)
            mass *= self.scale
        else:
            self.scale = 1.0
        self.unknown = 1 - mass


def unigram_model(stats):
    """Discounts with the mass of all seen words: counts above K are kept, so the loss is known from the counts of counts."""
    model = Discounts(stats)
    lost = sum(r * n * (1 - d) for r, n, d in zip(range(1, K + 1), stats[2:], model.factors[1:], strict=False))
    model.close(1 - lost / model.tokens if model.tokens else 0.0)
    return model


def unigram(model, counts):
    if not model.tokens:
        return np.ones(len(counts))
    scale, unknown = model.unigrams()
    return np.where(counts > 0, scale * model(counts) * counts / model.tokens, unknown)


# Bigrams --------------------------------------------------------------------------------------------------------

def _by_part(block, parts):
    """Distinct bigrams with their order by partition: (contexts, words, inverse, order, cuts)."""
    context, word, inverse = block.bigrams()
    names = np.append(block.words, START)
    part = ((names >> np.uint64(48)) % np.uint64(parts)).astype(np.int64)[context]
    order = np.argsort(part, kind="stable")
    return context, word, inverse, names, order, np.searchsorted(part[order], np.arange(parts + 1))


_ASK = "part int, block string, contexts binary, fans binary, dictionary binary, dictionary_counts binary, places binary, counts binary"


def _ask_bigrams(parts):
    def run(key, left, right):
        rows = []
        for name, trains, texts in zip(left["block"], left["trains"], left["texts"], strict=True):
            block = Block(texts)
            known = _word_counts(block, right, parts)
            context, word, inverse, names, order, cuts = _by_part(block, parts)
            counts = np.bincount(inverse, weights=block.trained(trains), minlength=len(context)).astype(np.int32)
            for p in range(parts):
                mine = order[cuts[p]:cuts[p + 1]]
                if len(mine):
                    heads, fans = np.unique(context[mine], return_counts=True)  # contexts are in order
                    used, places = np.unique(word[mine], return_inverse=True)
                    rows.append((p, name, names[heads].tobytes(), squeeze(fans.astype(np.int32)), squeeze_48(block.words[used]),
                                 squeeze(known[used]), squeeze(places.astype(np.int32)), squeeze(counts[mine])))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _ASK.split(", ")])
    return run


def squeeze_48(hashes):
    return np.ascontiguousarray((hashes & _MASK).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unsqueeze_48(data):
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _count_bigrams(model):
    def run(pdf):
        part = int(pdf["part"].iloc[0])
        heads = [np.frombuffer(c, np.uint64) for c in pdf["contexts"]]
        names, inverse = np.unique(np.concatenate(heads), return_inverse=True)
        ids = np.split(inverse, np.cumsum([len(h) for h in heads])[:-1])
        context, word, known, counts, sizes = [], [], [], [], []
        for i, row in zip(ids, pdf.itertuples(), strict=True):
            places = unsqueeze(row.places, np.int32)
            context.append(np.repeat(i, unsqueeze(row.fans, np.int32)).astype(np.uint32))
            word.append(unsqueeze_48(row.dictionary)[places])
            known.append(unsqueeze(row.dictionary_counts, np.int64)[places])
            counts.append(unsqueeze(row.counts, np.int32))
            sizes.append(len(places))
        context, word, known, counts = (np.concatenate(x) for x in (context, word, known, counts))
        order = np.lexsort((word, context))
        new = np.append(True, (np.diff(context[order]) != 0) | (np.diff(word[order]) != 0))
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        total = np.bincount(entry, weights=counts).astype(np.int64)
        owner, known = context[order][new], known[order][new]
        seen = total > 0
        n = len(names)
        sums = np.bincount(owner[seen], weights=unigram(model, known[seen]), minlength=n)
        totals = np.bincount(owner, weights=total, minlength=n).astype(np.int64)
        by_count = np.stack([totals, *(np.bincount(owner[total == r], minlength=n) for r in range(1, K + 1))], axis=1).astype(np.int64)
        rows = [(part, b, squeeze(total[e]), squeeze(by_count[i].ravel()), sums[i].tobytes(), None, None)
                for b, e, i in zip(pdf["block"], np.split(entry, np.cumsum(sizes)[:-1]), ids, strict=True)]
        rows.append((part, None, None, None, None, None, _stats(total)))
        return _answer(rows)
    return run


# Scores ---------------------------------------------------------------------------------------------------------

def _score(parts, model, bigram):
    def run(key, left, right):
        out = []
        for name, ids, held, texts in zip(left["block"], left["doc_ids"], left["held"], left["texts"], strict=True):
            block = Block(texts)
            known = _word_counts(block, right[right["totals"].isnull()], parts)
            lower = unigram(model, known)
            context, word, inverse, names, order, cuts = _by_part(block, parts)
            chance = np.empty(len(context))
            for row in right[right["totals"].notnull()].itertuples():
                mine = order[cuts[row.part]:cuts[row.part + 1]]
                heads, place = np.unique(context[mine], return_inverse=True)
                count = unsqueeze(row.counts, np.int64)
                table = unsqueeze(row.totals, np.int64).reshape(len(heads), K + 1)
                total, sums = table[:, 0], np.frombuffer(row.sums)
                lost = (table[:, 1:] * np.arange(1, K + 1) * (1 - bigram.factors[1:])).sum(1)
                whole = np.where(lost > 0, total, total + 1)  # without a loss, one count more to share
                free = np.where(total > 0, np.where(lost > 0, lost, 1) / np.maximum(whole, 1), 1.0)
                backoff = np.where(total > 0, free / np.maximum(1 - sums, 1e-300), 1.0)
                chance[mine] = np.where(count > 0, bigram(count) * count / np.maximum(whole, 1)[place], backoff[place] * lower[word[mine]])
            base = np.log10((known + 0.1) / (model.tokens + 0.1 * (model.types + 1)))
            at = block.begins
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(ids), "Int64"), "held_out": [bool(h) for h in held], "n_tokens": block.lengths,
                "n_known": np.add.reduceat((known[block.at] > 0).astype(np.int64), at), "train_tokens": model.tokens,
                "base_score": np.add.reduceat(base[block.at], at), "score": np.add.reduceat(np.log10(chance)[inverse], at)}))
        return pd.concat(out, ignore_index=True)
    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _summed(answers):
    """The statistics of all partitions added up."""
    row = answers.filter("block is null").agg(*(F.sum(F.get("stats", i)).alias(f"s{i}") for i in range(K + 3))).first()
    return [int(v or 0) for v in row]


def katz_scores(documents, block_bytes=BLOCK, part_bytes=PART):
    """Scores of all rows of (doc_id, text, trains, held_out), learning from those that train."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                            F.coalesce("trains", F.lit(False)).alias("trains"), F.coalesce("held_out", F.lit(False)).alias("held_out"))
    blocks = land(rows.mapInArrow(_pack(block_bytes), _BLOCK))
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    asked = blocks.select("block", "trains", "texts").mapInArrow(_ask_words(parts), "part int, block string, words binary, counts binary")
    words = land(asked.groupBy("part").applyInPandas(_count_words, _ANSWER))
    model = unigram_model(_summed(words))
    to_blocks = words.filter("block is not null").drop("keys", "stats")
    asked = blocks.select("block", "trains", "texts").groupBy("block").cogroup(to_blocks.select("block", "part", "counts").groupBy("block")).applyInPandas(_ask_bigrams(parts), _ASK)
    pairs = land(asked.groupBy("part").applyInPandas(_count_bigrams(model), _ANSWER))
    bigram = Discounts(_summed(pairs))
    answers = to_blocks.unionByName(pairs.filter("block is not null").drop("keys", "stats"))
    return blocks.drop("trains").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_score(parts, model, bigram), _SCORES)


def op6_katz_scores(spark, sf_dir):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", (fold != 0).alias("trains"), (fold == 0).alias("held_out"))
    return katz_scores(documents)
