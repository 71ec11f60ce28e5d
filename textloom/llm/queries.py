"""The contracted queries: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, exact_dedup, language_id, license_scan, mixing, ogg, pii, simhash, token_counts, url_filter
from textloom.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, WORD_BPE).select("doc_id", "counts.n_words", "counts.n_tokens")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, WORD_BPE, keep=False).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.col("language.ambiguous").alias("ambiguous"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", "mix.block", "mix.slot", "mix.position")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = ogg.store(docs).select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "media")
    return ogg.load(stored).select(
        "doc_id",
        "n_bytes",
        F.octet_length("loaded.payload").cast("long").alias("payload_bytes"),
        F.sha2("loaded.payload", 256).alias("payload_sha256"),
        ogg.tail_crc32("loaded.payload").alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.col("loaded.feature").alias("feature"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, spans = F.col("pii.base"), F.col("pii.spans")
    counts = [pii.count_of(base, k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(base).cast("binary"), 256).alias("base_sha256"), pii.as_text(spans).alias("spans"))


def op7_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_urls(pages)).drop("listed")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    x = "licenses."
    lists = [F.concat_ws(",", x + c).alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", *[F.col(x + c) for c in ("n_words", "n_base", "first_word", "last_word")], *lists, F.col(x + "score"))


QUERIES = {"op1_tokens": op1_tokens, "op2_bpe": op2_bpe, "op3_language": op3_language, "op4_mix": op4_mix, "op5_media": op5_media, "op6_pii": op6_pii, "op7_exact": op7_exact, "op8_urls": op8_urls, "op9_simhash": op9_simhash, "op10_licenses": op10_licenses}
SQL = {"op7_exact": exact_dedup.SQL, "op8_urls": url_filter.SQL}
