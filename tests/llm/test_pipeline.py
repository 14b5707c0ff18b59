"""Each stage against SQL or brute force on what its predecessor kept."""

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from trackspark.llm import decontaminate, language, lines, minhash, mixing

from .helpers import SF_DIR, duck

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", None, 0), (10**6 + 1, "", None, "x", 0), (10**6 + 2, "123", "en", "x", 3),
                                 (None, "A text without an id", "en", "x", 20)], docs.schema)
    docs = docs.unionByName(odd).withColumns({"kept": F.lit("k"), "key": F.lit(1), "score": F.lit(2.0)})
    names, inputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = str(tmp_path / name)
        docs.write.parquet(inputs[name])
        docs = stage(spark, spark.read.parquet(inputs[name]), SF_DIR)
        assert docs.columns == names + ["copy"] * (name == "mix_sources")
    inputs["end"] = str(tmp_path / "end")
    docs.write.parquet(inputs["end"])
    rows = lambda at: [r.asDict() for r in spark.read.parquet(inputs[at]).collect()]
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"])

    assert sorted(map(key, rows("line_dedup"))) == sorted(key(r) for r in rows("language_id") if language.has_letter(r["text"]))
    want = duck(lines.OP5_SQL, documents=inputs["line_dedup"])
    assert sorted(map(key, rows("minhash_dedup"))) == sorted(map(key, want))
    kept = {r["doc_id"] for r in duck(minhash.OP1_SQL, documents=inputs["minhash_dedup"]) if r["kept"] or r["doc_id"] is None}
    assert {r["doc_id"] for r in rows("decontaminate")} == kept
    clean = {r["doc_id"] for r in duck(decontaminate.OP2_SQL, documents=inputs["decontaminate"], benchmark=f"{SF_DIR}/benchmark*.parquet")
             if not r["contaminated"]}
    assert {r["doc_id"] for r in rows("mix_sources")} == clean
    copies = {r["doc_id"]: r["copies"] for r in duck(mixing.OP7_SQL, documents=inputs["mix_sources"]) if r["copies"]}
    got = {}
    for r in rows("end"):
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == copies


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.land(stage(spark, docs, SF_DIR))
        assert docs.count() == 0
