"""URL filters: rules first, then a blocked Bloom filter before an exact hash join, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ascii_lower, durable

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Words of 64 bits, each a block; 16 bits a listed URL, 6 of them set.
BITS_PER_URL, SET_BITS = 16, 6
#: Blocks up to which the filter is broadcast: 2^20 rows of two longs. A larger one is joined by a shuffle.
BROADCAST_BLOCKS = 1 << 20
#: Keys to which rows that aren't looked up are spread.
SPREAD = 4096
#: The list of the query: all pages of hosts with one of these names.
LISTED_NAMES = ("adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host and path without scheme, www. or m., .html, slashes at the end, fragment and tracking parameters; null for no host."""
    short = F.regexp_replace(host(url), r"\A(www|m)\.", "")
    place = F.regexp_replace(path(url), r"(\.html)?/*\z", "")
    asked = F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^?#]*\?([^#]*)", 1)
    asked = F.regexp_replace(F.regexp_replace(asked, r"(^|&)(utm_[^=&]*|ref)=[^&]*", ""), r"\A&+", "")
    return F.when(host(url) != "", F.concat(short, place, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise("")))


def fits(rule: tuple[str, str, str], host_: Column, path_: Column) -> Column:
    return ((host_ == rule[1]) | host_.endswith("." + rule[1])) & path_.startswith(rule[2])


def by_rule(rules: Sequence[tuple[str, str, str]], host_: Column, path_: Column, at: int | None) -> Column:
    """The longest rule that fits, as text (at None) or its verdict (at 0); null if none does.

    The rules are written into the plan, so there may be 1000 of them at most.
    """
    if len(rules) > 1000:
        raise ValueError("over 1000 rules")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    none = F.lit(None).cast("string")
    return reduce(lambda rest, r: F.when(fits(r, host_, path_), F.lit(r[1] + r[2] if at is None else r[at])).otherwise(rest), reversed(ordered), none)


def block_of(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def mask_of(url: Column) -> Column:
    """SET_BITS bits of a block's 64, from a second hash."""
    h = F.xxhash64(F.lit("mask"), url)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(SET_BITS)]
    return reduce(Column.bitwiseOR, bits)


def bloom(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """(block, word) of the blocks with a bit set; block words are or-ed before the shuffle."""
    return listed.groupBy(block_of(F.col(url), blocks).alias("block")).agg(F.bit_or(mask_of(F.col(url))).alias("word"))


def judge(pages: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(key, host, path, rule, verdict, listed) for every row of ``pages``.

    ``listed`` has one column of canonical URLs; nulls and repeated ones don't matter. A
    rule's verdict holds; else listed URLs are blocked and others allowed, null and
    malformed ones too. The Bloom filter passes possible hits to an exact join by URL,
    which takes out false ones. Repeated pages come out as often. ``pages`` is read once,
    ``listed`` once too, as its distinct URLs are written to the shared folder.
    """
    names = listed.columns
    known = durable(listed.select(F.col(names[0]).alias("canon")).where("canon IS NOT NULL").distinct())
    blocks = 1 << max(0, (known.count() * BITS_PER_URL // 64)).bit_length()
    words = bloom(known, "canon", blocks)
    u, h, p = F.col("url"), F.col("host"), F.col("path")
    rows = pages.select(F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").alias("url")).select("id", host(u).alias("host"), path(u).alias("path"), canonical(u).alias("canon"))
    rows = rows.select("*", by_rule(rules, h, p, None).alias("rule"), by_rule(rules, h, p, 0).alias("said"))
    open_ = F.col("rule").isNull() & F.col("canon").isNotNull()
    rows = rows.withColumn("block", F.when(open_, block_of(F.col("canon"), blocks)))
    # rows that aren't looked up have null keys; should a side be too large for a broadcast, another key spreads them
    apart = lambda c: F.when(c.isNull(), F.pmod(F.xxhash64("id", "path"), F.lit(SPREAD))).otherwise(0).cast("long")
    probed = rows.withColumn("apart", apart(F.col("block")))
    words = words.withColumn("apart", F.lit(0).cast("long"))
    probed = probed.join(F.broadcast(words) if blocks <= BROADCAST_BLOCKS else words, ["block", "apart"], "left")
    maybe = F.col("word").bitwiseAND(mask_of(F.col("canon"))) == mask_of(F.col("canon"))
    probed = probed.withColumn("sought", F.when(maybe, F.col("canon"))).withColumn("apart", apart(F.col("sought")))
    listed_ = known.select(F.col("canon").alias("sought"), F.lit(0).cast("long").alias("apart"), F.lit(True).alias("hit"))
    hit = F.coalesce(F.col("hit"), F.lit(False))
    verdict = F.coalesce("said", F.when(hit, "block").otherwise("allow"))
    out = probed.join(listed_, ["sought", "apart"], "left")
    return out.select(F.col("id").alias(key), "host", "path", "rule", verdict.alias("verdict"), hit.alias("listed"))


def listed_urls(pages: DataFrame, url: str = "url", names: Sequence[str] = LISTED_NAMES) -> DataFrame:
    """Canonical URLs of all pages of which a label of the host is one of ``names``."""
    labels = F.split(host(F.col(url)), r"\.")
    return pages.where(F.arrays_overlap(labels, F.array(*map(F.lit, names)))).select(canonical(F.col(url)).alias("canon"))


def _sql() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    test = "(host = '{1}' OR host LIKE '%.{1}') AND path LIKE '{2}%'"
    cases = {at: " ".join(f"WHEN {test.format(*r)} THEN '{r[1] + r[2] if at is None else r[at]}'" for r in ordered) for at in (None, 0)}
    return rf"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '://[^?#]*\?([^#]*)', 1), '(^|&)(utm_[^=&]*|ref)=[^&]*', '', 'g'), '\A&+', '') AS asked
  FROM pages
), c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '\A(www|m)\.', '') || regexp_replace(path, '(\.html)?/*\z', '') || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END END AS canon
  FROM p
), listed AS (
  SELECT DISTINCT canon FROM c WHERE list_has_any(string_split(host, '.'), [{", ".join(f"'{n}'" for n in LISTED_NAMES)}])
), r AS (
  SELECT *, CASE {cases[None]} END AS rule, CASE {cases[0]} END AS said, canon IN (SELECT canon FROM listed) AS hit FROM c
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN hit THEN 'block' ELSE 'allow' END) AS verdict FROM r
"""


SQL = _sql()
