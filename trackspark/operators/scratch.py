"""Intermediate results that are used twice are written once, to shared storage."""

import re
import tempfile
import uuid
from contextlib import contextmanager

_fallback = {}

# Files that a task has open at once before it sorts the rest of its rows by folder.
OPEN_FILES = 8


def scratch_dir(spark):
    """The shared folder named by ``spark.checkpoint.dir``; a local one where it is unset and all runs in one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all nodes of {master} share")
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="trackspark-")
    return _fallback[app]


@contextmanager
def folders_unsorted(spark, files=OPEN_FILES):
    """Writes into folders take rows in the order they come, with up to ``files`` files open in a task.

    By default Spark sorts all rows of a task by folder first, on top of any order that they have.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, files)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def land(df, by=()):
    """Write ``df`` as Parquet under the scratch folder and read it back, in folders by the columns ``by``.

    Cuts the lineage, survives the loss of executors and is computed once. The
    tables of a run are under its application id and may be deleted after it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/landed-{uuid.uuid4().hex}"
    with folders_unsorted(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
