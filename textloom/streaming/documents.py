"""Streams of documents: the same span operators over files as they arrive, with state where a run needs it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textloom.functions.determinism import key6
from textloom.operators.spans import extract


def arriving(spark: SparkSession, path: str, schema: str, most_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def windowed_counts(stream: DataFrame, patterns: Sequence[tuple[str, str]], time: str = "ts", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Spans of each kind by window of the documents' time; documents later than ``late`` are left out."""
    kept = stream.withWatermark(time, late)
    every = kept.select(F.col(time), F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_count(F.col("text"), F.lit(p)).alias("n")) for k, p in patterns])).alias("x"))
    return every.groupBy(F.window(time, window).alias("window"), F.col("x.kind").alias("kind")).agg(F.sum("x.n").alias("n"))


def keyed(stream: DataFrame, patterns: Sequence[tuple[str, str]], salt: str, key: str = "doc") -> DataFrame:
    """(key, kind, surrogate, original) as documents arrive; a hash gives the keys, so no state is held."""
    spans = extract(stream, patterns, key)
    return spans.select(key, "kind", key6(F.lit(salt), F.col(key).cast("string"), "kind", "text").alias("surrogate"), F.col("text").alias("original"))


def run_dictionary(spans: DataFrame) -> DataFrame:
    """(kind, text, number): a number for each text of a kind, in the order of arrival, the same in the whole run.

    The state is one counter and the seen texts of a (kind, initial) group, so that no
    kind is held in one place.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else []
        known = {t: i for i, t in enumerate(seen)}
        new = []
        for frame in frames:
            for text in sorted(frame["text"].dropna().unique()):
                if text not in known:
                    known[text] = len(known)
                    new.append(text)
        state.update((list(known),))
        if new:
            yield pd.DataFrame({"kind": key[0], "initial": key[1], "text": new, "number": [known[t] for t in new]})

    grouped = spans.withColumn("initial", F.substring(F.md5(F.col("text").cast("binary")), 1, 2)).groupBy("kind", "initial")
    return grouped.applyInPandasWithState(update, "kind string, initial string, text string, number long", "seen array<string>", "append", GroupStateTimeout.NoTimeout)
