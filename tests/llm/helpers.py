"""Brute-force helpers for the tests of this folder."""

import re

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


def documents(spark, texts, **columns):
    """A table of documents with ids from 0, and a column or two whose names clash with others."""
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def duck(sql, **tables):
    """Rows of ``sql`` over Parquet folders, as dictionaries."""
    import duckdb

    connection = duckdb.connect()
    for name, path in tables.items():
        connection.execute(f"create view {name} as select * from read_parquet('{path}/*.parquet')" if "*" not in path
                           else f"create view {name} as select * from read_parquet('{path}')")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return [dict(zip(names, row, strict=True)) for row in result.fetchall()]
