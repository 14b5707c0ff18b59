import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from trackspark.llm import suffixes


def test_suffix_array_equals_sorting():
    pick = random.Random(5)
    for _ in range(200):
        n, k = pick.randint(1, 60), pick.choice([1, 2, 3, 5, 200])
        x = np.array([pick.randint(0, k) for _ in range(n)], np.uint16)
        assert list(suffixes.suffix_array(x, n + 1)) == sorted(range(n), key=lambda i: list(x[i:]))


def expected(text, counts, length):
    data = (text or "").encode()
    mask = bytearray(len(data))
    for i in range(len(data) - length + 1):
        if counts[data[i:i + length]] > 1:
            mask[i:i + length] = b"\1" * length
    return len(data), sum(mask), sum(k for k, _ in itertools.groupby(mask)), bytes(x for x, y in zip(data, mask, strict=True) if not y)


@pytest.mark.parametrize(("most", "floor"), [(2_000, 280), (2, 280), (0, 24), (2_000, 14), (2, 17), (0, 14)])
def test_removal_equals_brute_force(spark, most, floor, monkeypatch):
    """Null, empty and periodic texts, copies, repeated ids; ``most`` sends grams down either way, a lesser ``floor`` counts shorter repeats."""
    pick, length = random.Random(5), 24
    parts = ["aé", "b", "cc", "\n", "d ", "xyz"]
    base = ["".join(pick.choice(parts) for _ in range(pick.randint(5, 60))) for _ in range(12)]
    texts = [None, "", "ab" * 40, "a" * 200, "b" * 10]
    for _ in range(60):
        texts.append("".join(pick.choice([pick.choice(base)[:pick.randint(5, 80)], "".join(pick.choice(parts) for _ in range(20))])
                             for _ in range(4)))
    texts += texts[10:20]
    rows = [(pick.choice([i, None, 3]), t) for i, t in enumerate(texts)]
    counts, short = (Counter(d[i:i + n] for t in texts for d in [(t or "").encode()] for i in range(len(d) - n + 1))
                     for n in (length, min(floor, length)))
    monkeypatch.setattr(suffixes, "PIECE", 100)
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length, 6, most, 3_000, floor).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(key((*r[:4], bytes(r[4]), r[5])) for r in got) == sorted(
        key((i, *expected(t, counts, length), expected(t, short, min(floor, length))[1])) for i, t in rows)


def test_passages_on_both_sides_of_the_length(spark):
    """Passages of 330 to 500 bytes, each in two texts: from 400 bytes on they are removed, all of them count as repeated."""
    pick = random.Random(8)
    text = lambda n: "".join(pick.choice("abcdefghij klmnopq") for _ in range(n))
    sizes = [330, 350, 399, 400, 401, 500]
    rows = [(2 * i + k, text(700 + 13 * i) + " " + passage + "#" * (k + 1) + text(500)) for i, passage in enumerate(map(text, sizes)) for k in (0, 1)]
    rows += [(100 + i, text(900)) for i in range(5)]
    got = {r.doc_id: (r.n_removed, r.n_repeated) for r in suffixes.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string"), floor=320).collect()}
    for i, size in enumerate(sizes):
        for k in (0, 1):  # a space before and a mark behind are shared too
            removed, repeated = got[2 * i + k]
            assert repeated in (size + 2, size + 3) and removed == (repeated if repeated >= 400 else 0)
    assert all(got[100 + i] == (0, 0) for i in range(5))


def test_query_tells_planted_passages_from_clean_documents(spark, tmp_path):
    """Passages of over 50 words, each in two documents: ``n_removed`` tells those of 400 bytes or more; ``n_bytes`` is the text's length."""
    pick = random.Random(9)
    word = lambda: "".join(pick.choice("abcdefghijklmnopq") for _ in range(pick.randint(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    passages = [words(n) for n in (51, 52, 53, 54, 75, 80, 90, 120)]
    sizes = [len(passage) for passage in passages]
    assert max(sizes[:4]) < 390 and min(sizes[4:]) >= 400
    texts = {2 * i + k: f"{words(150 + i)} <{k} {passage} {k}> {words(60)}" for i, passage in enumerate(passages) for k in (0, 1)}
    texts |= {100 + i: words(200 + i) for i in range(10)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffixes.op4_suffix_dedup(spark, str(tmp_path)).collect()}
    assert all(got[i].n_bytes == len(text) for i, text in texts.items())
    for i, size in enumerate(sizes):
        for k in (0, 1):  # the spaces around it are shared too
            assert (got[2 * i + k].n_removed, got[2 * i + k].n_spans) == ((size + 2, 1) if size >= 400 else (0, 0))
    assert all(got[100 + i].n_removed == 0 for i in range(10))


def test_texts_move_twice_and_single_grams_do_not_join(spark, monkeypatch):
    """Also where grams of few and of many contexts meet, and on small tables: for the contexts, and for the removal."""
    pick = random.Random(6)
    text = lambda n: "".join(pick.choice("abcdefghij klmnopq") for _ in range(n))
    often, twice = text(60), text(60)
    rows = [(i, text(100) + often + text(90)) for i in range(6)] + [(10 + i, text(80) + twice + text(70)) for i in range(2)] + [(20, text(3_000))]
    landed = []
    monkeypatch.setattr(suffixes, "land", lambda df, f=suffixes.land: landed.append((df, f(df))) or landed[-1][1])
    removed = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 24, 6, 3)
    assert all(r.n_removed >= 60 if r.doc_id < 20 else r.n_removed == 0 for r in removed.collect())
    found, joined = (df for _, df in landed[:2])
    assert set(found.columns) == set(joined.columns) and joined.count() < found.count() / 2
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in [*(df for df, _ in landed), removed]]
    moving = [plan for plan in plans if "Join" in plan and re.search(r"\btext#", plan.split("Join", 1)[1])]
    assert len(moving) == 2
    assert "BroadcastHashJoin" not in removed._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
