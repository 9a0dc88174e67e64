"""The corpus operators over their whole tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embedding_dedup, filter_audit, host_quality, language_id, line_dedup, mixing, oracles, prefix_trie
from . import secret_scan, sharding, simhash, substring_dedup, url_filter
from .common import small_batches, stored

# Whole shares of a period of 100 slots; sources that are not named share "*"
TARGETS = {"src0": 20, "src1": 10, "src2": 10, "src3": 8, "src4": 8, "src5": 6, "src6": 6, "src7": 4, "src8": 4, "*": 24}
BLOCK = 16
VOCABULARY = "byte_bpe_50k.json"
MIN_SCORE = 0.3
SHINGLE, NEAR_BITS = 4, 4
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def vocabulary() -> str:
    """Path of the public vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source")
    return mixing.mix(docs, TARGETS, BLOCK)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(documents(spark, sf_dir)).drop("_text")


def train_languages(docs: DataFrame) -> language_id.Network | None:
    """From the rows that are not held out."""
    learned = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2
    return language_id.fit(docs.where(F.coalesce(learned, F.lit(True))).select("text", "lang"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = train_languages(docs)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return language_id.predict(docs.select("doc_id", "text"), net).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), SHINGLE, NEAR_BITS)


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.98)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", listed.alias("spans"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), vocabulary(), ids=False)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.drop_lines(docs)


def op9_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.judge(documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = stored(documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")), "sizes")
    placed = sharding.assign(docs, 40, ties=("text_crc32", "size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [op1_mixing, op2_substring_dedup, op3_language_id, op4_simhash, op5_embedding_dedup, op6_secrets, op7_bpe,
             op8_line_dedup, op9_host_quality, op10_sharding, op11_filter_audit, op12_prefix_trie, op13_url_filter, pipeline]
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql(TARGETS, BLOCK, URL_RULES)
