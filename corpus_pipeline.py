"""From raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir); its result is written and read again as the next
one's docs, and all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, exact_dedup, language_id, mixing, simhash
from textloom.llm.common import shared_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the classifier tells with certainty; texts without letters go."""
    model = language_id.train(docs)
    found = language_id.identify(docs, model, into="identified_language")
    sure = (F.col("identified_language.lang") != language_id.UNDETERMINED) & ~F.col("identified_language.ambiguous")
    return found.where(sure).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix over the written files."""
    placed = mixing.mix(docs, into="place_in_mix")
    return mixing.in_order(placed, "place_in_mix", docs.count()).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with each document's place in the mix: reading files doesn't keep their order, so it is told again here."""
    placed = mixing.mix(docs.select("doc_id", "lang", "source", "text"), into="place_in_mix")
    return bpe.round_trip(placed, TOKENIZER, keep=False).select(
        "doc_id",
        "lang",
        "source",
        "place_in_mix.block",
        "place_in_mix.slot",
        "place_in_mix.position",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language id", known_language),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixed),
    ("token ids", encoded),
]

#: SQL can't express the classifier, the fingerprints or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        if k:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            remove(spark, f"{folder}/{k - 1}")  # what the stage before read is not needed again
        docs = stage(spark, docs, sf_dir)
    return docs


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
