"""Dictionary lookups: enrichment by text, merged code lists, fallbacks, closest prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def enrich(mentions: DataFrame, dictionary: DataFrame, text: str = "text", first_only: bool = False) -> DataFrame:
    """``codes``: sorted codes of each mention's text in ``dictionary`` (text, code); empty without, one at most with ``first_only``.

    Texts are looked up once each, whatever the number of their mentions.
    """
    known = dictionary.select(F.col("text").alias("_text"), "code")
    once = mentions.select(F.col(text).alias("_text")).distinct().join(known, "_text")
    codes = F.array_sort(F.collect_set("code"))
    lists = once.groupBy("_text").agg((F.slice(codes, 1, 1) if first_only else codes).alias("codes"))
    out = mentions.join(lists, mentions[text] == lists["_text"], "left").drop("_text")
    return out.withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))


def single(mentions: DataFrame, dictionary: DataFrame, text: str = "text") -> DataFrame:
    """``code`` where the dictionary has exactly one row for a text, else null."""
    lone = dictionary.groupBy(F.col("text").alias("_text")).agg(F.count("*").alias("_n"), F.min("code").alias("code")).where("_n = 1").drop("_n")
    return mentions.join(lone, mentions[text] == lone["_text"], "left").drop("_text")


def merge_codes(first: DataFrame, others: list[DataFrame]) -> DataFrame:
    """The first source's rows by (anno_type, id), with the codes of the others' rows of the same id after its own."""
    out, none = first, F.array().cast(first.schema["codes"].dataType)
    for other in others:
        more = other.select(F.col("anno_type").alias("_type"), F.col("id").alias("_id"), F.col("codes").alias("_codes"))
        out = out.join(more, (out["anno_type"] == more["_type"]) & (out["id"] == more["_id"]), "left")
        out = out.withColumn("codes", F.concat("codes", F.coalesce("_codes", none))).drop("_type", "_id", "_codes")
    return out


def without(results: DataFrame, filtered: DataFrame) -> DataFrame:
    """Rows of ``results`` that ``filtered`` lacks."""
    return results.join(filtered.distinct(), [results[c].eqNullSafe(filtered[c]) for c in results.columns], "left_anti")


def restrict(code: Column, keys: list[str]) -> Column:
    """Only these keys of a map."""
    return F.map_filter(code, lambda k, _: k.isin(*keys))


def with_fallback(mentions: DataFrame, dictionary: DataFrame, text: str = "text") -> DataFrame:
    """``surrogate`` by text, or by ``A-`` and the text, or else LOCATION; ``dictionary`` has (text, surrogate)."""
    a = dictionary.select(F.col("text").alias("_a"), F.col("surrogate").alias("_sa"))
    b = dictionary.select(F.col("text").alias("_b"), F.col("surrogate").alias("_sb"))
    out = mentions.join(a, mentions[text] == a["_a"], "left").join(b, F.concat(F.lit("A-"), mentions[text]) == b["_b"], "left")
    return out.withColumn("surrogate", F.coalesce("_sa", "_sb", F.lit("LOCATION"))).drop("_a", "_sa", "_b", "_sb")


def union_with_precedence(dictionaries: list[DataFrame], keys: list[str]) -> DataFrame:
    """All rows of all dictionaries; of a key's rows, the later dictionary's."""
    parts = [d.withColumn("_rank", F.lit(i)) for i, d in enumerate(dictionaries)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    names = [c for c in every.columns if c not in (*keys, "_rank")]
    best = every.groupBy(*keys).agg(F.max_by(F.struct(*names), "_rank").alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}") for c in names])


def closest_code(numbers: DataFrame, codes: DataFrame, number: str = "number", longest: int = 12) -> DataFrame:
    """The code that shares the longest prefix with each number: (number, code, city, shared).

    Of several, the one whose next digit is nearest to the number's, codes without one
    last; where the number has no next digit, the numerically nearest; then the least code. Every prefix of the numbers and of the codes is a row
    of an equi-join, so no pair without a common prefix is made; a number without any
    common digit gets no row.
    """
    ask = numbers.select(F.col(number).alias("number")).distinct().where(F.col("number").rlike("^[0-9]+$"))
    prefixes = lambda df, c: df.select("*", F.explode(F.sequence(F.lit(1), F.least(F.length(c), F.lit(longest)))).alias("shared")).withColumn("_p", F.substring(F.col(c), F.lit(1), F.col("shared")))
    held = prefixes(codes.select("code", "city"), "code")
    asked = prefixes(ask, "number")
    # of the prefixes that any code has, each number's longest, before it meets the codes
    have = held.select("_p").distinct()
    best = asked.join(have, "_p", "left_semi").groupBy("number").agg(F.max("shared").alias("shared"))
    best = best.withColumn("_p", F.substring(F.col("number"), F.lit(1), F.col("shared")))
    pairs = best.join(held.drop("shared"), "_p")
    digit = lambda c: F.substring(F.col(c), F.col("shared") + 1, F.lit(1)).cast("int")
    ended = F.length("number") == F.col("shared")
    next_off = F.when(ended, 0).when(F.length("code") == F.col("shared"), 10).otherwise(F.abs(digit("code") - digit("number")))
    far = F.when(ended, F.abs(F.col("code").cast("decimal(38,0)") - F.col("number").cast("decimal(38,0)"))).otherwise(0)
    order = Window.partitionBy("number").orderBy(next_off, far, "code")
    return pairs.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("number", "code", "city", "shared")


def deal(notes: DataFrame, nodes: DataFrame, by: list[str], note_order: list[str], node_order: list[str]) -> DataFrame:
    """The n-th note of a group goes to its n-th node; what is left over on either side is dropped."""
    a = notes.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*note_order)))
    b = nodes.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*node_order)))
    return a.join(b, [*by, "_n"]).drop("_n")
