import os
import random

import numpy as np
import pytest
from trackspark.llm import language

from .helpers import SF_DIR, documents


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "lang")
    got = language.op8_language_id(spark, SF_DIR.replace("0.001", "0.01")).join(truth, "doc_id").filter("held_out").collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_null_empty_unlabelled_and_clashing(spark):
    df = documents(spark, [None, "", "123 !", "Was ist das", "x" * 900_000]).selectExpr("*", "1 as score", "2 as lang_pred")
    nothing = language.identify(df, language.fit_on_documents(df.selectExpr("doc_id", "text", "cast(null as string) as lang")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    got = {r.doc_id: r for r in language.identify(df, language.fit_on_documents(df)).collect()}
    assert [got[i].lang_pred for i in range(5)] == ["und", "und", "und", "en", "en"]
    assert language.identify(df.limit(0), language.fit_on_documents(df.limit(0))).collect() == []


def test_prediction_ignores_all_but_the_text(spark):
    df = documents(spark, ["der die das und", "the and of that"] * 20).selectExpr(
        "doc_id", "text", "if(doc_id % 2 = 0, 'de', 'en') as lang")
    model = language.fit_on_documents(df)
    a = language.identify(df, model).select("text", "lang_pred", "score").distinct().collect()
    b = language.identify(df.selectExpr("doc_id + 7 as doc_id", "text", "'fr' as lang"), model).select("text", "lang_pred", "score").distinct().collect()
    assert sorted(a) == sorted(b) and {(r.text[:3], r.lang_pred) for r in a} == {("der", "de"), ("the", "en")}


def test_scores_equal_a_plain_kernel_ridge(spark):
    """With all rows as landmarks: kernels from sets of grams as they are, one dense system."""
    pick = random.Random(3)
    words = {"de": "der die das und nicht ein mit auf ist".split(), "en": "the and of that with this from not is".split()}
    rows = [(i, lang, " ".join(pick.choice(words[lang]) for _ in range(12))) for i, lang in enumerate(["de", "en"] * 12)]
    model = language.fit(spark, spark.createDataFrame(rows, "id long, lang string, text string"), sample=1_000, landmarks=1_000)

    def grams(text):
        data = text.lower().encode()
        return {data[i:i + n] for n in language.GRAMS for i in range(len(data) - n + 1)}

    def kernel(a, b):
        return len(a & b) / (len(a) * len(b)) ** 0.5

    sets, n = [grams(text) for _, _, text in rows], len(rows)
    among = np.array([[kernel(a, b) for b in sets] for a in sets])
    goal = np.array([1.0 if lang == "de" else -1.0 for _, lang, _ in rows])
    centred = among - among.mean(0)
    weights = np.linalg.solve(centred.T @ centred + language.RIDGE * n * among + 1e-8 * n * np.eye(n), centred.T @ (goal - goal.mean()))
    texts = [text for _, _, text in rows[:4]] + ["das ist nicht the", "of that und this is from", "with der and die"]
    for text, (lang, score) in zip(texts, model.predict(texts), strict=True):
        value = goal.mean() + (np.array([kernel(grams(text), s) for s in sets]) - among.mean(0)) @ weights
        assert lang == ("de" if value > 0 else "en") and score == pytest.approx(min((abs(value) + 1) / 2, 1), abs=0.02)
