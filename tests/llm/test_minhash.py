import random

import numpy as np
import pytest
from trackspark.llm import minhash
from trackspark.llm.components import connected_components

from .helpers import words


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(rows):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


@pytest.fixture(scope="module")
def rows():
    """Chains of near copies, exact copies, null and short texts, a null id, repeated rows."""
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(3):
        base = [pick.choice(vocabulary) for _ in range(120)]
        for _ in range(20):
            copy = base[:]
            for _ in range(pick.randint(0, 9)):
                copy[pick.randrange(120)] = pick.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", " \n", "a b c", "A b C", texts[0]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b c"), (3, texts[3]), (4, texts[25]), (5, "x y")]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize(("rounds", "rare"), [(2, 64), (1, 64), (1, 8), (1, 1)])
def test_components_equal_those_of_all_pairs(spark, rows, rounds, rare, monkeypatch):
    """With one leader round more is left to the prefix join, with few rare minima to comparing whole buckets in small chunks."""
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", rounds)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), chunk=7, rare=rare).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == components(rows)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_long_text_and_empty_table(spark):
    text = " ".join(f"x{i % 4001}" for i in range(60_000))
    df = spark.createDataFrame([(1, text), (2, text + " end")], "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(df).collect()) == [(1, 4001, 1, True), (2, 4002, 1, False)]
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_minima_estimate_similarity():
    pick = np.random.Generator(np.random.PCG64(1))
    a = pick.integers(0, 2**63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], pick.integers(0, 2**63, 600, dtype=np.uint64)])
    equal = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(equal - 2400 / 3600) < 0.17


def test_long_path_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(5, 5), (None, 2)], "u long, v long")
    got = connected_components(edges).collect()
    assert len(got) == 300 and {r.component for r in got} == {0}


def test_a_shared_passage_makes_work_in_proportion(spark, monkeypatch):
    """Texts that share one passage and nothing else: twice the texts give no pairs, and few members to compare in buckets."""
    met, meetings = [], minhash._meetings

    def counted(apart, chunk):
        out = meetings(apart, chunk)
        met.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_meetings", counted)
    pick = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    for n in (150, 300):
        texts = [passage + " " + " ".join(str(pick.random()) for _ in range(60)) for _ in range(n)]
        found = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), chunk=16, rare=8).collect()
        assert all(r.kept for r in found)
        assert sum(met) <= 4 * n
        met.clear()


def test_sets_meet_by_the_same_joins_at_every_size(spark, monkeypatch):
    """No set is broadcast, however few there are, and the second look takes minima of the unsettled members only."""
    pick = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(str(pick.random()) for _ in range(60)) for _ in range(60)]
    texts += [" ".join(str(pick.random()) for _ in range(40)) for _ in range(200)]
    texts += [texts[i] + " more" for i in range(60, 70)]
    looks, plans, verified, land = [], [], minhash._verified, minhash.land
    monkeypatch.setattr(minhash, "_verified", lambda pairs, minima, *rest: looks.append(minima.count()) or verified(pairs, minima, *rest))
    monkeypatch.setattr(minhash, "land", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or land(df))
    found = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sum(not r.kept for r in found) == 10
    assert looks[0] == 270 and 0 < looks[1] < 100
    confirmed = [plan for plan in plans if "(u, v, a, b)" in plan or "run(u#" in plan and "a#" in plan and "b#" in plan and "ma#" not in plan]
    assert confirmed and all("BroadcastHashJoin" not in plan for plan in confirmed)
