"""Quality rules per document, and verdicts per host that lean on a prior.

A host of few documents says little about itself, so its failure rate is drawn
towards the others': a beta prior is fitted to the rates of all hosts by their
mean and variance, and the host's posterior mean is what counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, WHITE_CHARS, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def rules(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, ``others`` and the counts of whole texts; null text counts as empty.

    n_repeat_words compares windows by a 64-bit digest of their words.
    """
    base = docs.select("doc_id", *others, F.coalesce("text", F.lit("")).alias("_text"))
    split = F.filter(F.split("_text", WHITE), lambda w: w != "")
    lined = F.filter(F.split("_text", "\n"), lambda x: F.translate(x, WHITE_CHARS, "") != "")
    out = base.select(
        "doc_id", *others, split.alias("_words"), lined.alias("_lines"),
        F.length(F.translate("_text", WHITE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    out = (out.withColumn("n_words", F.size("_words").cast("long"))
           .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
           .withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words", "_lines"))
    at = F.sequence(F.lit(0), F.size("_hash") - WINDOW)
    windows = F.transform(at, lambda i: F.xxhash64(*[F.get("_hash", i + k) for k in range(WINDOW)]))
    out = out.withColumn("_windows", F.when(F.size("_hash") >= WINDOW, windows).otherwise(F.expr("array()").cast("array<long>")))
    out = out.drop("_hash").withColumn("_some", F.size(F.array_distinct("_windows")) < F.size("_windows"))

    # only texts with a repeated window are sorted: equal windows then stand side by side
    pairs = F.when(F.col("_some"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    out = out.withColumn("_pairs", pairs).drop("_windows")
    twice = F.filter("_pairs", lambda p, k: F.coalesce(p.h == F.get("_pairs", k - 1).h, F.lit(False))
                     | F.coalesce(p.h == F.get("_pairs", k + 1).h, F.lit(False)))
    out = out.withColumn("_at", F.sort_array(F.transform(twice, lambda p: p.i))).drop("_pairs")
    # a window covers its words up to the next repeated window
    gaps = F.transform("_at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0), lambda n, g: n + g)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select("doc_id", *others, *COUNTS)


def base_failed(min_words: int = 10, max_repeat_percent: int = 20):
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def hosts(checked: DataFrame, host_col: str, max_rate: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, host_failed) from rows with host and base_failed.

    The prior has the mean of all rows and the spread of the hosts' rates;
    hosts that do not differ give the strongest prior allowed, 1000 documents.
    """
    # stored: a row per host, whose size decides how it is joined, with a host of very many rows split if need be
    per = stored(checked.where(F.col(host_col).isNotNull()).groupBy(host_col)
                 .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    total = per.agg(F.sum("n_failed") / F.sum("n_docs"), F.var_pop(rate)).first()  # one row
    mean, spread = total[0] or 0.0, total[1] or 0.0
    strength = min(1000.0, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else 1000.0
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return per.withColumn("host_rate", shrunk).withColumn("host_failed", F.col("host_rate") > max_rate)


def judge(docs: DataFrame, host_col: str = "source", max_rate: float = 0.5) -> DataFrame:
    """doc_id, host, the counts, base_failed, host_rate and kept, one row per row of ``docs``.

    kept: the document passes its own rules and its host's rate is at most
    ``max_rate``. A null host has no rate, and its documents stand on their own
    rules. Null text is empty and so fails; an empty table stays empty;
    repeated rows each count and each get a row; other columns are left out.
    """
    counted = rules(docs.withColumn("_host", F.col(host_col)), "_host").withColumn("base_failed", base_failed())
    checked = stored(counted, "rules")
    verdict = hosts(checked, "_host", max_rate).select("_host", "host_rate", "host_failed")
    kept = ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))
    return checked.join(verdict, "_host", "left").select(
        "doc_id", F.col("_host").alias("host"), *COUNTS, "base_failed", F.round("host_rate", 6).alias("host_rate"),
        kept.alias("kept"))
