"""A session with the settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "textloom", master: str | None = None, shuffle_partitions: int = 200, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.parquet.compression.codec": "zstd",
    } | settings
    return builder.config(map=conf).getOrCreate()
