"""Exact dedup by content-defined chunk recipes, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ascii_lower, durable, fresh, without

#: A chunk ends after a line, or between a consonant at a word's end and a vowel at the next one's start,
#: but not before 384 characters; where no such place comes, after 4096.
CHUNK = r"(?s).{384,4096}?(?<=\n|[dnrst][ ,.][aeio])|.{1,4096}"

#: Groups of copies that are broadcast with their recipes, and chunks in these recipes together: 16 bytes each.
LARGE_GROUPS, LARGE_RECIPES = 100_000, 2_000_000
#: Rows that a group of copies has at least if it is broadcast for its size.
LEAST_LARGE = 1000


def digest(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk.cast("binary")))


def normalized(text: Column) -> Column:
    """A-Z lower-cased; null is an empty text."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def second_digest(chunk: Column) -> Column:
    """What verifies an identifier: a digest independent of it, which two chunks of one identifier don't share."""
    return F.substring(F.unhex(F.sha2(chunk.cast("binary"), 256)), 1, 16)


def recipes(docs: DataFrame, key: str, text: str, identify: Callable[[Column], Column] = digest) -> DataFrame:
    """(row, id, recipe, text_sha256) of every row, written to the shared folder.

    Every chunk's identifier is verified: all its chunks have one second digest, or else
    all recipes carry second digests too. Texts are read and cut once, and don't move;
    identifiers do, each with its least and greatest second digest once a task.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), normalized(F.col(text)).alias("text"))
    cut = rows.select("row", "id", chunks(F.col("text")).alias("chunks"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    made = durable(cut.select("row", "id", F.transform("chunks", identify).alias("recipe"), F.transform("chunks", second_digest).alias("seconds"), "text_sha256"))
    both = F.arrays_zip(F.col("recipe").alias("ident"), F.col("seconds").alias("second"))
    held = made.select(F.explode(both).alias("c")).groupBy("c.ident").agg(F.min("c.second").alias("a"), F.max("c.second").alias("b"))
    if held.where("a <> b").limit(1).count():
        made = made.withColumn("recipe", both)
    return made.drop("seconds")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", identify: Callable[[Column], Column] = digest) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal if they are after lower-casing A-Z; null is an empty text. The row
    with the largest key stays; of rows with one text and that key, one; keys that are
    null come last. An empty table gives no rows.

    Recipes are counted in partial sums before they move. A recipe of one row needs no
    partner; those of more are looked up, the large groups among them by a broadcast of
    LARGE_GROUPS rows at most, so that no task gets a large group's rows.
    """
    rows = recipes(docs, key, text, identify)
    counted = rows.groupBy("recipe").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size"))
    copied = durable(counted.where("group_size > 1"))
    total = copied.agg(F.sum("group_size"), F.count("*"), F.sum(F.size("recipe"))).first()
    out = F.struct(F.col("id"), F.col("row"))
    alone = lambda c, other: F.coalesce(F.col(c), other).alias(c)
    made = ["id", "row", "text_sha256", alone("best", out), alone("group_size", F.lit(1).cast("long"))]
    if (total[1] or 0) <= LARGE_GROUPS and (total[2] or 0) <= LARGE_RECIPES:
        looked = rows.join(F.broadcast(copied), "recipe", "left").select(*made)
    else:
        # no more than LARGE_GROUPS groups can have so many rows; recipes of them that are long are left to the shuffle
        most = max(LEAST_LARGE, -(-total[0] // LARGE_GROUPS))
        large = F.broadcast(copied.where((F.col("group_size") >= most) & (F.size("recipe") <= LARGE_RECIPES // LARGE_GROUPS)))
        looked = rows.join(large, "recipe").select(*made)
        looked = looked.unionByName(rows.join(large.select("recipe"), "recipe", "left_anti").join(copied, "recipe", "left").select(*made))
    kept = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("row") == F.col("best.row"))
    return looked.select(F.col("id").alias(key), F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that exact_groups drops, all columns as they were.

    What is looked up are the dropped rows' keys and digests; texts move only if these are too many to be sent to every task.
    """
    sha, id_ = fresh(docs.columns, "sha"), fresh(docs.columns, "kept_id")
    found = durable(exact_groups(docs, key, text).select(F.col(key).alias(id_), F.unhex("text_sha256").alias(sha), "kept"))
    rows = found.groupBy(id_, sha).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    gone = durable(rows.where("NOT kept").select(id_, sha))
    digest_ = F.unhex(F.sha2(normalized(F.col(text)).cast("binary"), 256))
    out = without(docs, gone, [F.col(key), digest_])
    if rows.where("kept AND n > 1").limit(1).count():
        out = out.withColumn(sha, digest_).dropDuplicates([key, sha])  # rows with one key and text: any of them
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents
), g AS (
  SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256
FROM t JOIN g ON t.x = g.x
"""
