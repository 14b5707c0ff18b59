"""Language identification by string kernels.

The kernel of two texts is the number of distinct byte n-grams of 2 to 4 bytes they share (each gram counts
once, all lengths blended), divided by the root of the product of their numbers of distinct grams. Grams are hashed to
``DIMENSIONS`` places. A kernel ridge regression, one language against the rest, is fitted on
Nyström landmarks. As the kernel is linear in the grams of the text to score, landmarks and coefficients are
multiplied out once, and a batch of texts is scored as one product of its gram matrix with that matrix.

The classifier is fitted on a bounded sample: about ``SAMPLE`` labelled rows in all, as many of each language,
picked by the hash of their id, of which ``LANDMARKS`` serve as landmarks. Their gram sets, of ``DIMENSIONS`` bits each, not their texts,
come to the driver. Prediction reads the whole text and nothing else.

Defined cases: a null text, and a text without a letter, is ``und`` with score 0; so is everything if no
labelled row exists. Rows with a null id are not learned from and not held out. Ties go to the language first by
code point. Repeated rows get equal results. An empty table gives no rows. Other
columns are kept; one that has the name of a result is replaced.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import others

GRAMS = (2, 3, 4)
DIMENSIONS = 1 << 15
SAMPLE = 2_400
LANDMARKS = 256
RIDGE = 1e-3
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
_PIECE = 1 << 18
_ROWS = 128


def _codes(data, n):
    """Hashed codes of all ``n``-grams of a byte array."""
    m = len(data) - n + 1
    if m <= 0:
        return np.empty(0, np.uint32)
    code = data[:m].astype(np.uint32)
    for k in range(1, n):
        code |= data[k:k + m].astype(np.uint32) << np.uint32(8 * k)
    code = (code ^ np.uint32(n * 0x3C6EF372)) * np.uint32(2654435769)
    code ^= code >> np.uint32(15)
    return (code * np.uint32(2246822519)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)


def mark_grams(text, row):
    """Set the places of the grams of ``text`` in the array ``row``."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, len(data), _PIECE):
        piece = data[at:at + _PIECE + max(GRAMS) - 1]
        for n in GRAMS:
            row[_codes(piece, n)] = 1


def has_letter(text):
    return text is not None and any(map(str.isalpha, text))


def _gram_sets(batches):
    for batch in batches:
        langs, texts, bits = [], [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if has_letter(text):
                row = np.zeros(DIMENSIONS, np.uint8)
                mark_grams(text, row)
                langs.append(lang)
                bits.append(np.packbits(row).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(bits, pa.binary())], ["lang", "bits"])


class Model:
    """Languages and the matrix that turns gram sets into one score per language."""

    def __init__(self, languages, matrix, bias):
        self.languages, self.matrix, self.bias = languages, matrix, bias

    def predict(self, texts):
        """(language, score) per text; the score is the best regression value, from [-1, 1] to [0, 1]."""
        out = []
        for at in range(0, len(texts), _ROWS):
            part = texts[at:at + _ROWS]
            grams = np.zeros((len(part), DIMENSIONS), np.float32)
            letters = np.array([has_letter(t) for t in part], bool)
            for i in np.flatnonzero(letters):
                mark_grams(part[i], grams[i])
            if not self.languages:
                out += [(UNKNOWN, 0.0)] * len(part)
                continue
            size = np.sqrt(np.maximum(grams.sum(1, keepdims=True), 1))
            values = (grams @ self.matrix) / size + self.bias
            best = values.argmax(1)
            score = np.clip((values[np.arange(len(part)), best].astype(float) + 1) / 2, 0, 1)
            out += [(self.languages[b], float(s)) if ok else (UNKNOWN, 0.0)
                    for b, s, ok in zip(best, score, letters, strict=True)]
        return out


def fit(spark, labelled, sample=SAMPLE, landmarks=LANDMARKS, ridge=RIDGE):
    """A model from rows (id, lang, text): their number is bounded by ``sample`` on average, and by twice it always."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], None, None)
    each = max(sample // len(counts), 1)
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, each / n)))))
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), "id"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)
    rows = (
        labelled.filter(drawn).orderBy(F.xxhash64("id"), "id").limit(2 * sample).select("lang", "text")
        .mapInArrow(_gram_sets, "lang string, bits binary").collect()
    )
    if not rows:
        return Model([], None, None)
    languages = sorted({r["lang"] for r in rows})
    turn, taken = {}, []
    for i, r in enumerate(rows):  # languages in turn, so that each has landmarks
        turn.setdefault(r["lang"], []).append(i)
    for k in range(max(map(len, turn.values()))):
        taken += [turn[lang][k] for lang in languages if k < len(turn[lang])]
    unpack = lambda part: np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in part]), axis=1).astype(np.float32)
    marks = unpack([rows[i] for i in taken[:landmarks]])
    marks /= np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))
    among = (marks @ marks.T).astype(np.float64)
    m, left, right, sums, total = len(marks), 0.0, 0.0, 0.0, 0.0
    for at in range(0, len(rows), 128):
        part = rows[at:at + 128]
        grams = unpack(part)
        kernel = (grams @ marks.T / np.sqrt(np.maximum(grams.sum(1, keepdims=True), 1))).astype(np.float64)
        goal = np.array([[1.0 if r["lang"] == lang else -1.0 for lang in languages] for r in part])
        left, right = left + kernel.T @ kernel, right + kernel.T @ goal
        sums, total = sums + kernel.sum(0), total + goal.sum(0)
    n = len(rows)
    mean, bias = sums / n, total / n
    left, right = left - n * np.outer(mean, mean), right - np.outer(sums, bias)
    weights = np.linalg.solve(left + ridge * n * among + 1e-8 * n * np.eye(m), right)
    return Model(languages, (marks.T @ weights).astype(np.float32), (bias - mean @ weights).astype(np.float32))


def fold(id_column):
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))


def identify(documents, model):
    """``documents`` with lang_pred and score, from ``text`` alone; nothing else goes through Python."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict(texts.tolist()), columns=["lang_pred", "score"])

    # Not deterministic for the optimizer, which would else run it again for a filter on its result.
    found = documents.select(*others(documents, "lang_pred", "score"), score.asNondeterministic()("text").alias("_language"))
    return found.select(*(F.col(f"`{c}`") for c in found.columns[:-1]), "_language.lang_pred", "_language.score")


def fit_on_documents(documents, **options):
    """A model from the labelled documents outside the held-out fold."""
    labelled = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id") != HELD_OUT))
    return fit(documents.sparkSession, labelled.select(F.col("doc_id").alias("id"), "lang", "text"), **options)


def op8_language_id(spark, sf_dir):
    from .common import read_table

    documents = read_table(spark, sf_dir, "documents")
    model = fit_on_documents(documents)
    held_out = F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out")
    return identify(documents.select("doc_id", held_out, "text"), model).select("doc_id", "held_out", "lang_pred", "score")
