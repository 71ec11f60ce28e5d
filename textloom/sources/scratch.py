"""Cutting long lineages through the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session that names none gets one of this machine, which goes with the process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="checkpoints")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` from files in the shared folder."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)
