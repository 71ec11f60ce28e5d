"""Quality control of annotations: counts by kind, verdicts, errors, pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.dates import quarter
from textloom.operators.spans import contained

REVIEWED = ("OTHER", "PROFESSION", "LOCATION_OTHER", "AGE")


def is_wrong(kind: Column) -> Column:
    return kind.isNull() | (kind == "OTHER")


def counts(spans: DataFrame, key: str = "doc") -> DataFrame:
    """(key, kind, n, mentions): spans and sorted distinct texts of each kind in a document."""
    return spans.groupBy(key, "kind").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("text")).alias("mentions"))


def nested_counts(spans: DataFrame, key: str = "doc") -> DataFrame:
    """(key, kind, n) over pairs of a span and those within it, so a nested span counts once for each around it."""
    pairs = contained(spans.select(key, "begin", "end"), spans.select(key, "begin", "end", "kind"), key)
    return pairs.groupBy(key, F.col("inner_kind").alias("kind")).agg(F.count("*").alias("n"))


def verdict(spans: DataFrame, key: str = "doc") -> DataFrame:
    """(key, part_of_corpus): 0 for documents with a span without kind or of kind OTHER, else 1; none without spans."""
    return spans.groupBy(key).agg(F.min(F.when(is_wrong(F.col("kind")), 0).otherwise(1)).alias("part_of_corpus"))


def pivot(spans: DataFrame, kinds: Sequence[str], key: str = "doc") -> DataFrame:
    """One row a document, the number of spans of each kind in a column of its own, 0 where there are none."""
    out = spans.groupBy(key).pivot("kind", list(kinds)).agg(F.count(F.lit(1)))
    return out.na.fill(0, list(kinds))


def birth_counts(docs: DataFrame, spans: DataFrame, key: str = "doc") -> DataFrame:
    """(key, n) of the documents that have no birth date or several."""
    births = spans.where("kind = 'DATE_BIRTH'").groupBy(key).agg(F.count("*").alias("n"))
    return docs.select(key).join(births, key, "left").na.fill(0, ["n"]).where("n != 1")


def invalid_dates(spans: DataFrame, key: str = "doc") -> DataFrame:
    """Birth and death dates that aren't understood, each with its kind."""
    return spans.where(F.col("kind").isin("DATE_BIRTH", "DATE_DEATH") & (quarter(F.col("text")) == "none")).select(key, "kind", "begin", "end", "text")


def errors(spans: DataFrame, key: str = "doc") -> DataFrame:
    return spans.where(is_wrong(F.col("kind"))).select(key, "kind", "begin", "end", "text")


def review(spans: DataFrame, kinds: Sequence[str] = REVIEWED, key: str = "doc") -> DataFrame:
    return counts(spans.where(F.col("kind").isin(*kinds)), key)


def split(verdicts: DataFrame, key: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Documents that are taken, and those that are left out."""
    return verdicts.where("part_of_corpus = 1").select(key), verdicts.where("part_of_corpus = 0").select(key)
