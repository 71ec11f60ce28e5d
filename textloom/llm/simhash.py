"""SimHash near-duplicates: tiled exact comparison of fingerprints."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import shingle_join
from textloom.llm.common import durable, fresh, with_made, without
from textloom.llm.components import components
from textloom.llm.tiles import keyed_links, ones_of

SLICE = 65_536


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits, of which one is 1 if set in over half of the hashes of the word shingles; no words, no bits.

    A-Z are lower-cased, words are split at ASCII white space, repeated shingles count
    again; a text of fewer words is one shingle.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(parts))
    count = len(parts) - k + 1
    ones = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, count, SLICE):
        to = min(at + SLICE, count)
        h = np.array([hashed(joined[s:e], 42) for s, e in zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist(), strict=True)], np.uint64)
        ones += ones_of(h, 64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint) of every row, the fingerprint as a signed long; a null text has no words."""
    slim = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def one(t: str | None) -> int:
        value = fingerprint(t, words)
        return value - (value >> 63 << 64)

    return with_made(slim, "text", "fingerprint", T.LongType(), lambda: one, keep=False)


def masks(distinct: int, radius: int) -> list[int]:
    """Bit masks of which any two fingerprints within the radius agree on one.

    64 bits are cut into more blocks than the radius; some choice of radius blocks holds
    all the differences, so the others agree. More blocks give rarer keys: there are as
    many as keep the mean key under 256 fingerprints, as far as 64 bits allow.
    """
    blocks = radius + 1
    while blocks < 2 * radius + 2 and distinct >> (64 * (blocks - radius) // blocks) > 256:
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def keys_of(values: DataFrame, radius: int) -> DataFrame:
    """(key, fingerprint) of the fingerprints, so that any two within the radius share a key."""
    value = F.col("fingerprint")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(values.count(), radius)]
    # a key is a hash: two masks' keys that collide are compared together, which links nothing wrong
    return values.select(F.explode(F.array(*[F.xxhash64(F.lit(i), value.bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])).alias("key"), value)


def near_links(values: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (u, v) that connect the distinct fingerprints of ``values`` lying within the radius, through others of their key at times."""
    return keyed_links(keys_of(values, radius), radius)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``docs``.

    component_id is the least key reachable by links of at most ``radius`` differing bits,
    equal fingerprints and those of texts without words included. Null and empty texts
    have the fingerprint 0. Null keys are no one's least key, unless a component has no
    other. Repeated rows come out as often as they came in; no rows, no result rows.
    """
    found = durable(fingerprints(docs, key, text, words))
    distinct = durable(found.groupBy("fingerprint").agg(F.min("id").alias("least")))
    roots = components(near_links(distinct, radius))
    grouped = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "root").select("fingerprint", "component_id")
    out = found.join(named, "fingerprint")
    return out.select(F.col("id").alias(key), "fingerprint", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group, that of the least key; all columns as they were.

    Groups are components of texts whose sets of word shingles have this Jaccard
    similarity or more: wide fingerprints, compared tile by tile, give the candidates,
    and a link counts if the sets themselves are as similar. Texts without words are a
    group. Of several texts with the least key, the one with the least digest stays.
    """
    id_, mark_ = fresh(docs.columns, "gone_id"), fresh(docs.columns, "mark")
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    named = docs.select(F.struct(F.col(key).alias("id"), digest.alias("mark")).alias("id"), F.col(text).alias("text"))
    found = durable(shingle_join.near_sets(named, words, similarity).withColumn("stays", F.col("id").eqNullSafe(F.col("component_id"))))
    gone = durable(found.where("NOT stays").select(F.col("id.id").alias(id_), F.col("id.mark").alias(mark_)).distinct())
    out = without(docs, gone, [F.col(key), digest])
    if found.where("stays").groupBy("id").count().where("count > 1").limit(1).count():
        out = out.withColumn(mark_, digest).dropDuplicates([key, mark_])  # rows with one key and text: any of them
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def as_hex(value: str) -> F.Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
