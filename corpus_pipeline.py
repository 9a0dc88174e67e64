"""A corpus made ready for training: language, repeated lines, near duplicates, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each result
is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import bpe, language_id, line_dedup, mixing, queries, simhash
from shopstream.llm.common import small_batches, stored

# Where the metadata of the sources hold the mix of a table
MIX = "mix"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter, or whose language is a guess, go.

    The network is fitted to the stage's own documents; a text it can't place
    with a probability of MIN_SCORE is rejected. Null and empty texts go.
    """
    small_batches(spark)
    labelled = language_id.predict(docs, queries.train_languages(docs))
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= queries.MIN_SCORE)
    return labelled.where(known).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring template lines; n_chars follows the text.

    Null and empty texts, repeated rows and an empty table stay as they are.
    """
    cut = line_dedup.drop_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of ``op4_simhash``: fingerprints of four-word shingles, four bits.

    Null ids lose to any other; rows that share the smallest id are told apart
    by digests of their text, then of the row. Texts without words are one group.
    """
    small_batches(spark)
    return simhash.keep_first(docs, queries.SHINGLE, queries.NEAR_BITS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes their sources to the target weights.

    A null source counts as any other unnamed one; rows of one id are ordered by a digest of the row.
    Files have no order, so the mix decided on here goes with the table, as metadata of its sources.
    """
    mix = {"sources": list(queries.TARGETS), "shares": list(queries.TARGETS.values()), "block": queries.BLOCK}
    source = F.col("source").alias("source", metadata={MIX: mix})
    placed = mixing.mix(docs, queries.TARGETS, queries.BLOCK).orderBy("position")
    return placed.select(*(source if c == "source" else c for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256, position, in_mix) of every document.

    Files that are read again have no order, so positions follow from ids and
    sources by the mix that the stage before has put with the table; documents
    that were not mixed have none.
    """
    small_batches(spark)
    mix = docs.schema["source"].metadata.get(MIX)
    if mix:
        placed = mixing.mix(docs, dict(zip(mix["sources"], mix["shares"])), mix["block"])
    else:
        placed = docs.withColumns({"position": F.lit(None).cast("long"), "in_mix": F.lit(None).cast("boolean")})
    return bpe.encode(placed, queries.vocabulary(), keep=("position", "in_mix"))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mixture),
    ("bpe", tokens),
]

# A trained network and a vocabulary decide the rows, so there is no SQL for them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
