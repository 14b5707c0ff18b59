"""Small cases of the operators that use DataFrame functions only."""

from pyspark.sql import functions as F
from trackspark.llm import decontaminate, lines, mixing, secrets

from .helpers import documents


def test_lines(spark):
    """Later windows go, the first stays; overlapping copies, short, null, repeated and clashing rows."""
    a = "one\ntwo\nthree"
    texts = [a, "x\n" + a + "\ny", None, "", "one\ntwo", "r\nr\nr\nr\nr", "\n\n\n\n", "p\nq\ns\r"]
    df = documents(spark, texts).selectExpr("*", "7 as n_lines", "'k' as key")
    df = df.unionByName(df.filter("doc_id = 1"))
    got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert [got[i].text for i in range(8)] == [a, "x\ny", None, "", "one\ntwo", "r", "\n\n\n\n", "p\nq\ns\r"]
    assert [(got[i].n_lines, got[i].n_removed) for i in range(8)] == [(3, 0), (5, 3), (0, 0), (1, 0), (2, 0), (5, 4), (5, 0), (3, 0)]
    assert got[1].n_chars == 3 and got[1].key == "k"
    assert lines.dedup_lines(df).count() == 9 and lines.dedup_lines(df.limit(0)).count() == 0


def test_decontaminate(spark):
    ten = "a1 b c d e f g h i j"
    items = spark.createDataFrame(
        [(1, ten.upper()), (10, ten + " k"), (2, "Short one"), (3, None), (4, " .,"), (None, "x y z"), (5, "short ONE")], "item_id long, text string")
    texts = [f"pre {ten}, k post", "a1-b.c d e f g h i", "a short. one here", None, "", "x y z", "né short onÉ", ten + " " + ten]
    df = documents(spark, texts).selectExpr("*", "1 as n_hit")
    got = {r.doc_id: r for r in decontaminate.contamination(df, items).collect()}
    assert [(got[i].n_words, got[i].n_hit, list(got[i].item_ids)) for i in range(8)] == [
        (13, 11, ["1", "10"]), (9, 0, []), (4, 2, ["2", "5"]), (0, 0, []), (0, 0, []), (3, 3, []), (3, 0, []), (20, 20, ["1", "10"])]
    assert [got[i].contaminated for i in range(8)] == [True, False, True, False, False, True, False, True]
    assert decontaminate.contamination(df, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(df.limit(0), items).count() == 0


def test_winnowing_finds_every_shared_span(spark):
    """Any ten words of a long item, anywhere in a text."""
    item = [f"w{i}" for i in range(60)]
    texts = [" ".join(["q"] * (s % 7) + item[s:s + 10] + ["z"] * (s % 5)) for s in range(51)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(documents(spark, texts), items).collect()] == [10] * 51


def test_mixing(spark):
    texts = [("w " * (1 + i % 9)) if i % 11 else None for i in range(400)]
    df = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") < 10, None).when(F.col("doc_id") < 300, "a").otherwise("b"))
    df = df.unionByName(df.filter("doc_id = 5")).withColumn("copy", F.lit("mine"))
    drawn = mixing.draw(df).collect()
    assert len(drawn) == 401
    for source in {r.source for r in drawn}:
        rows = [r for r in drawn if r.source == source]
        taken = sum(r.copies * r.size for r in rows)
        assert abs(taken - rows[0].target) <= 2 * max(r.size for r in rows)
        assert rows[0].target <= 2 * rows[0].source_size and max(r.copies for r in rows) <= 2
    total = sum(r.size for r in drawn)
    assert abs(sum({r.source: r.target for r in drawn}.values()) - 1.5 * total) < 1e-6
    mixed = mixing.mix_documents(df).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("m")).collect()
    copies = {r.doc_id: r.copies for r in drawn if r.copies and r.doc_id != 5}
    assert {r.doc_id: r.n for r in mixed if r.doc_id != 5} == copies and all(r.m == r.n for r in mixed if r.doc_id != 5)
    assert sorted(drawn) == sorted(mixing.draw(df.repartition(5)).collect())
    assert mixing.draw(df.limit(0)).count() == 0


def test_mixing_shares_the_excess(spark):
    """Sizes 10, 10, 100 at weights 5, 2, 1: the first two stop at twice their size."""
    sizes = spark.createDataFrame([("a", 10), ("b", 10), ("c", 100), ("d", 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 20.0, "b": 20.0, "c": 140.0, "d": 0.0}


def test_secrets(spark):
    key, own = "AKIA" + "B" * 16, "q7" + "Zx9" * 8
    texts = [f"é {key} password: '{'p' * 8}'", f"token={own}", f"{own} and {key}", f"{key}", None, "", "secret: token: abcdefghij",
             "AKIASHORT password=short", "f" * 40 + " " + "0" * 31, "nothing\0here" + "a" * 32]
    df = documents(spark, texts).withColumn("source", F.concat(F.lit("o"), F.col("doc_id") % 4)).withColumn("n_hex", F.lit(9))
    spans = secrets.find_secrets(df)
    got = {r.doc_id: r for r in secrets.summarise(df, spans).collect()}
    assert got[0].base == "access:2:22,assign:23:42" and got[1].base == "assign:0:32"
    assert got[2].spans == f"token:0:{len(own)},access:{len(own) + 5}:{len(own) + 25}" and got[2].n_token == 1
    assert (got[3].n_live, got[3].n_copied) == (0, 1)  # the key has three owners
    assert [got[i].spans for i in (4, 5, 6, 7)] == ["", "", "", ""]
    assert got[8].base == "hex:0:40" and got[9].base == "hex:8:44".replace("8:44", "11:44")
    assert secrets.summarise(df.limit(0), secrets.find_secrets(df.limit(0))).count() == 0


def test_ownership_counts_repositories_once(spark):
    """Three texts of one repository and owner are one repository; a second owner of two repositories, one of them shared, adds one."""
    key = "AKIA" + "Z" * 16
    rows = [(f"{i} {key}", r, o) for i, (r, o) in enumerate([("r1", "a"), ("r1", "a"), ("r1", "a"), ("r2", "b"), ("r1", "b"), (None, None)])]
    df = spark.createDataFrame(rows, "text string, repository string, source string")
    found = secrets.find_secrets(df, repository="repository").filter("kind = 'access'").select("repositories", "owners", "live").distinct().collect()
    assert [tuple(r) for r in found] == [(2, 3, False)]
    one = secrets.find_secrets(df.filter("source = 'a'"), repository="repository").filter("kind = 'access'").select("repositories", "owners", "live")
    assert [tuple(r) for r in one.distinct().collect()] == [(1, 1, True)]
