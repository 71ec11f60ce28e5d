"""The de-identification run: quality control, then rewriting of the documents that pass, with their keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators import pseudonyms, quality


@dataclass
class Run:
    documents: DataFrame
    keys: DataFrame | None
    verdicts: DataFrame
    counts: DataFrame


def run(docs: DataFrame, spans: DataFrame, mode: str, salt: str, key: str = "doc", gate: bool = True, **options) -> Run:
    """One plan for all documents: those that quality control leaves out don't appear in the result.

    Without ``gate`` all documents with spans are taken.
    """
    verdicts = quality.verdict(spans, key)
    taken = spans
    if gate:
        passed = verdicts.where("part_of_corpus = 1").select(key)
        taken = spans.join(passed, key, "left_semi")
        docs = docs.join(passed, key, "left_semi")
    made = pseudonyms.replacements(taken, mode, salt, key, **options)
    keys = pseudonyms.assign_keys(taken, salt, key, mode, options.get("unique", True)) if mode == "keyed" else None
    return Run(pseudonyms.apply(docs, made, key), keys, verdicts, quality.counts(spans, key))


def write(result: Run, public: str, private: str, run_id: str) -> None:
    """Texts go to the public folder; places of the spans, keys and the report to the private one."""
    result.documents.drop("moved").withColumn("run_id", F.lit(run_id)).write.mode("errorifexists").partitionBy("run_id").parquet(f"{public}/texts")
    result.documents.withColumn("run_id", F.lit(run_id)).write.mode("errorifexists").partitionBy("run_id").parquet(f"{private}/documents")
    if result.keys is not None:
        result.keys.withColumn("run_id", F.lit(run_id)).write.mode("errorifexists").partitionBy("run_id").parquet(f"{private}/keys")
    result.counts.withColumn("run_id", F.lit(run_id)).write.mode("errorifexists").partitionBy("run_id").parquet(f"{private}/quality")
