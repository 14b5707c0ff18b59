"""Source divergence: skybands and whole audits against plain counts; defined cases."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from trackspark.llm import divergence

from .helpers import DOCS, low


def audit(docs, min_docs=3, top=200):
    """(lang, source, part, item, value, rank) by plain counting."""
    docs = [(low(t), lang or "", source or "") for t, lang, source in docs]
    found, whole = {}, {}
    for text, lang, source in docs:
        terms = re.findall(r"[^\x00-\x60\x7B-\x7F]+", text)
        found.setdefault((lang, source), Counter()).update(terms)
        whole.setdefault(lang, Counter()).update(set(terms))
    out = []
    for lang in whole:
        kept = [t for t, n in whole[lang].items() if n >= min_docs]
        groups = {s: c for (of, s), c in found.items() if of == lang}
        every = Counter()
        for c in groups.values():
            every.update(c)

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        all_ = shares(every)
        for s in groups:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s]
            term = [(t, (p[s][t] - all_[t]) ** 2 // all_[t]) for t in kept if groups[s][t] and p[s][t] > all_[t]]
            for part, rows in (("pair", pair), ("term", term)):
                ranked = sorted(rows, key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def _docs():
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzé"] + ["Ünï", "日本"]
    docs = []
    for i in range(120):
        n = int(rng.integers(0, 40))
        docs.append((" ".join(rng.choice(words, n, p=None)) + (" A-b3 RARE" if i % 40 == 0 else ""), "en" if i % 3 else "de", f"s{i % 4}"))
    return docs + [(None, "en", "s1"), ("", None, None), ("ax ax ax", None, "s1"), ("12 !", "fr", "only"), ("q" * 200_000 + " ax", "en", "s9"),
                   docs[5], docs[5]]


@pytest.mark.parametrize(("top", "buffer"), [(200, 100_000), (5, 7), (1, 1)])
def test_audit_equals_plain_counts(spark, top, buffer):
    docs = _docs()
    rows = [(i, t, lang, source, 0) for i, (t, lang, source) in enumerate(docs)]
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as rank", "'x' as term")
    got = sorted(tuple(r) for r in divergence.audit(frame, top=top, buffer=buffer).collect())
    assert got == audit(docs, top=top)


def test_terms_are_counted_before_they_leave_a_task(spark):
    """One row per group and term however often it occurs, also with few terms held, and long texts in slabs."""
    docs = [("ax bx AX 7ax", "en", "s"), ("ax", "en", "s"), (None, "en", None), ("cé " * 400_000 + "q" * 1_200_000, "de", "t"), ("ax", "en", "u")]
    frame = spark.createDataFrame([(i, *d, 0) for i, d in enumerate(docs)], DOCS).coalesce(1)
    wanted = [("de", "t", "cé", 400_000, 1), ("de", "t", "q" * 1_200_000, 1, 1), ("en", "s", "ax", 4, 2), ("en", "s", "bx", 1, 1), ("en", "u", "ax", 1, 1)]
    blank = frame.fillna("").select("lang", "source", "text")
    schema = "lang string, source string, term string, n long, docs long"
    assert sorted(tuple(r) for r in blank.mapInArrow(divergence._count_terms(100), schema).collect()) == wanted
    for limit in (100, 1):
        assert sorted(tuple(r) for r in divergence.term_counts(frame, limit).collect()) == wanted
    plan = divergence.term_counts(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_language_without_kept_terms(spark):
    docs = [("a", "en", "x"), ("b", "en", "y")]
    got = divergence.audit(spark.createDataFrame([(i, *d, 0) for i, d in enumerate(docs)], DOCS)).collect()
    assert sorted(tuple(r) for r in got) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 9)), min_size=1, max_size=60), st.integers(1, 4))
def test_skyband_counts_dominators(points, k):
    rows = sorted((-n, l, i) for i, (n, l) in enumerate(points))  # noqa: E741
    n, lang_n, place = (np.array(c) for c in zip(*((-a, b, c) for a, b, c in rows), strict=True))
    mask = divergence.skyband(n, lang_n, place, k)
    for i in range(len(n)):
        above = sum((n[j] >= n[i]) and (lang_n[j] <= lang_n[i]) and place[j] < place[i] for j in range(len(n)))
        assert mask[i] == (above < k)
