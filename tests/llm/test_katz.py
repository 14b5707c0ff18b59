import math
import os
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from trackspark.llm import katz

from .helpers import SF_DIR, words


def factors(counts):
    n = Counter(counts)
    last = 6 * n[6] / n[1] if n[1] else 1
    out = {}
    for r in range(1, 6):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last) if n[r] and last < 1 else -1
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return lambda c: out.get(c, 1.0)


class Model:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.one, self.two = Counter(), defaultdict(Counter)
        for t in texts:
            for h, w in self.tokens(t):
                self.one[w] += 1
                self.two[h][w] += 1
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.d1 = factors(self.one.values())
        self.d2 = factors([c for x in self.two.values() for c in x.values()])
        self.unknown = 1 - sum(self.d1(c) * c / self.n for c in self.one.values())

    @staticmethod
    def tokens(text):
        w = [*words(text), "</s>"]
        return list(zip(["<s>", *w[:-1]], w, strict=True))

    def p1(self, w):
        return self.d1(self.one[w]) * self.one[w] / self.n if self.one[w] else self.unknown

    def p2(self, h, w):
        total = sum(self.two[h].values()) if h in self.two else 0
        if not total:
            return self.p1(w)
        lost = sum(c * (1 - self.d2(c)) for c in self.two[h].values())
        whole = total if lost > 0 else total + 1
        if self.two[h][w]:
            return self.d2(self.two[h][w]) * self.two[h][w] / whole
        return (lost if lost > 0 else 1) / whole / (1 - sum(self.p1(x) for x in self.two[h] if self.two[h][x])) * self.p1(w)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
def test_scores_equal_a_model_of_dictionaries(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(60).collect()
    rows = [tuple(r) for r in table] + [(100_000, None), (100_001, ""), (100_001, "")]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    model = Model([t for i, t in rows if not held(i)])
    for h in list(model.two)[:8]:
        assert abs(sum(model.p2(h, w) for w in list(model.one)) + model.p2(h, "\0") - 1) < 1e-9
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"trains": fold != 0, "held_out": fold == 0})
    got = katz.katz_scores(df, block_bytes=20_000, part_bytes=40_000).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        tokens = model.tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(tokens), model.n)
        assert r.n_known == sum(model.one[w] > 0 for _, w in tokens)
        assert abs(r.base_score - sum(math.log10((model.one[w] + 0.1) / (model.n + 0.1 * (model.v + 1))) for _, w in tokens)) < 1e-6
        assert abs(r.score - sum(math.log10(model.p2(h, w)) for h, w in tokens)) < 1e-6


def test_no_training_rows_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b", None, None), (1, None, False, True)], "doc_id long, text string, trains boolean, held_out boolean")
    got = katz.katz_scores(df).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert katz.katz_scores(df.limit(0)).collect() == []
