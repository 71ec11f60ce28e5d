"""Rounds of the components leave no growing pile of shuffle files."""

from pathlib import Path

from pyspark.sql import functions as F

from textloom.llm import common, components


def test_rounds_release_their_files(spark, monkeypatch):
    edges = spark.range(4000).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).where("u % 1000 != 999")
    called = []
    monkeypatch.setattr(components, "released", lambda s: (called.append(1), common.released(s)))
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert set(roots.values()) == {0, 1000, 2000, 3000} and roots[1999] == 1000
    assert len(called) > 2  # once a round


def test_released_removes_unused_shuffles(spark):
    import time

    folders = [Path(f) for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()]
    count = lambda: sum(1 for f in folders for _ in f.rglob("shuffle_*.data"))
    common.released(spark)
    time.sleep(2)
    first = count()
    spark.range(100).repartition(7).groupBy("id").count().collect()
    assert count() > first
    for _ in range(20):
        common.released(spark)
        time.sleep(0.5)
        if count() <= first:
            break
    assert count() <= first
