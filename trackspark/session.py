"""Session settings the engine is designed around."""

from pyspark.sql import SparkSession


def build_session(app="trackspark", master=None, **conf):
    """A session with adaptive execution on; every setting can be overridden.

    Shuffle partitions are left to the cluster: adaptive execution merges small
    ones, so a large initial number is safe at scale.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
