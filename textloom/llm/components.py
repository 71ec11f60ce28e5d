"""Connected components by star contraction, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import durable, released


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the component's least node.

    Rounds of large and small stars turn each component into a star around its least
    node. A hub's neighbours are only reduced to a minimum or joined to it, never
    gathered in one place. Loops and repeated edges are allowed; no edges, no rows. After
    each round Spark is let remove what the earlier ones left on disk.
    """
    now = durable(edges.select(F.col(edges.columns[0]).alias("u"), F.col(edges.columns[1]).alias("v")).where("u != v").distinct())
    before = None
    for _ in range(most_rounds):
        now = durable(_small_star(_large_star(now)).where("u != v").distinct())
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
        before = mark
        released(now.sparkSession)
    raise RuntimeError("the components have not settled")
