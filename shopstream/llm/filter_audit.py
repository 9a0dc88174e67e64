"""What each order of five filters removes, from one truth-table word per document.

A document fails some of the filters; its survival word has bit S set when it
survives the subset S of filters. Carry-save adders count the bits of all
words of a part and label, position by position: 32 counts say how many
documents survive every subset, and any order's figures are differences of
them. Nothing is run per order.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
ROWS = 1 << 18  # documents counted at once


def survival_words() -> np.ndarray:
    """The word of every failure mask: bit S is set where the mask and S share no filter."""
    return np.array([sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)], np.uint32)


def positional_popcount(words: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """(groups, 32): how many words of each group have each bit set; ``group`` is sorted.

    Full adders turn three words of a group and weight into a sum of that
    weight and a carry of twice the weight, until a group has two words at
    most of each weight; only those are spread into bits.
    """
    out, weight = np.zeros((groups, 32), np.int64), 1
    while len(words):
        carried: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            rank = np.arange(len(group)) - np.searchsorted(group, group)
            full = rank // 3 * 3 + 3 <= np.bincount(group, minlength=groups)[group]
            if not full.any():
                break
            a, b, c = (words[full & (rank % 3 == k)] for k in range(3))
            of = group[full & (rank % 3 == 0)]
            carried.append(((a & b) | (c & (a ^ b)), of))
            words, group = np.concatenate([a ^ b ^ c, words[~full]]), np.concatenate([of, group[~full]])
            order = np.argsort(group, kind="stable")
            words, group = words[order], group[order]
        bits = words[:, None] >> np.arange(32, dtype=np.uint32) & np.uint32(1)
        np.add.at(out, group, bits.astype(np.int64) * weight)
        words = np.concatenate([w for w, _ in carried]) if carried else words[:0]
        group = np.concatenate([g for _, g in carried]) if carried else group[:0]
        order = np.argsort(group, kind="stable")
        words, group, weight = words[order], group[order], 2 * weight
    return out


def _counted(waiting: list[pa.RecordBatch], words: np.ndarray) -> pa.RecordBatch:
    t = pa.Table.from_batches(waiting).combine_chunks()
    part = t["part"].combine_chunks().dictionary_encode()
    names, kind = part.dictionary, t["kind"].to_numpy()
    group = part.indices.to_numpy().astype(np.int64) * 4 + kind
    order = np.argsort(group, kind="stable")
    counts = positional_popcount(words[t["fails"].to_numpy()[order]], group[order], 4 * len(names))
    some = np.flatnonzero(counts[:, 0])  # every word has bit 0: the empty subset removes nothing
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * 32), pa.array(counts[some].ravel()))
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(some // 4)), pa.array((some % 4).astype(np.int32)), lists], ["part", "kind", "survivors"])


def subset_survivors(marked: DataFrame) -> DataFrame:
    """(part, total, good, toxic): three arrays of 32 counts a part, from rows of part, kind (1 good, 2 toxic) and fails."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, waiting, held = survival_words(), [], 0
        for b in batches:
            if b.num_rows:
                waiting.append(b)
                held += b.num_rows
            if held >= ROWS:
                yield _counted(waiting, words)
                waiting, held = [], 0
        if waiting:
            yield _counted(waiting, words)

    per = marked.select("part", "kind", "fails").mapInArrow(count, "part string, kind int, survivors array<long>")
    per = per.select("part", "kind", F.posexplode("survivors").alias("subset", "n"))

    def of(bit: int) -> Column:
        return F.sum(F.when(F.col("kind").bitwiseAND(bit) != 0, F.col("n")).otherwise(0))

    sums = per.groupBy("part", "subset").agg(F.sum("n").alias("total"), of(1).alias("good"), of(2).alias("toxic"))
    row = F.sort_array(F.collect_list(F.struct("subset", "total", "good", "toxic")))  # 32 of them
    return sums.groupBy("part").agg(row.alias("_r")).select("part", "_r.total", "_r.good", "_r.toxic")


def failures(docs: DataFrame, part_col: str = "source") -> DataFrame:
    """(_id, part, _text, fails): a bit for each of the filters A to D that the text fails; _text is its SHA-256."""
    base = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("_w", F.filter(F.split("text", WHITE), lambda w: w != ""))
    n, different = F.size("_w"), F.size(F.array_distinct("_w"))
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    symbols = F.length(F.translate("text", "#$%&*|", "")) < F.length("text")
    fails = [n < 200, 100 * different < 50 * n, 100 * capitals > 2 * F.length("text"), symbols]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return base.select("_id", "part", F.unhex(F.sha2("text", 256)).alias("_text"), mask.alias("fails"))


def marked(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """(part, kind, fails) of every document, with filter E and the labels.

    Copies are found by aggregating ids per digest. Only texts that occur
    twice are joined back, and both sides of each join are stored tables, so
    Spark can split a text or an id with very many rows.
    """
    base = stored(failures(docs, part_col), "failures")
    first = (base.groupBy("_text").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
             .where("_n > 1").select("_text", "_first"))
    quality, toxic = F.coalesce(F.col("quality") == 1, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False))
    kind = labels.where(F.col("doc_id").isNotNull() & (quality | toxic)).groupBy(F.col("doc_id").alias("_of")).agg(
        (F.max(quality.cast("int")) + 2 * F.max(toxic.cast("int"))).alias("kind"))
    copy = F.when(F.col("_id") > F.col("_first"), 1 << 4).otherwise(0)
    rows = base.join(stored(first, "copies"), "_text", "left").select("_id", "part", (F.col("fails") + copy).alias("fails"))
    rows = rows.join(stored(kind, "labels"), F.col("_id") == F.col("_of"), "left")
    return rows.select("part", F.coalesce("kind", F.lit(0)).alias("kind"), "fails")


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """part, filter_order, step and the counts of that step: 600 rows a part.

    Null text is empty (fails A only, and E beside other empty texts); a null
    part is ''. Ties of ids: repeated rows of the smallest doc_id all pass E.
    A null doc_id is neither smaller nor larger, so it never fails E, and has
    no label; a document with several labels rows is good or toxic if one says
    so. Repeated rows each count. No documents give no rows. Texts of any
    length are read whole; other columns are left out.
    """
    parts = subset_survivors(marked(docs, labels, part_col))
    others = [s for s in range(SUBSETS)]

    def shapley(f: int) -> Column:
        gone = [(factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()), s) for s in others if not s >> f & 1]
        return sum((w * (F.get("total", F.lit(s)) - F.get("total", F.lit(s | 1 << f))) for w, s in gone), F.lit(0).cast("long"))

    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = (parts.withColumn("_shapley", F.array(*[shapley(f) for f in range(len(FILTERS))]))
            .withColumn("filter_order", F.explode(orders))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))))

    def bit(i: Column) -> Column:
        return F.expr("shiftleft(1, ascii(substring(filter_order, {}, 1)) - ascii('A'))".format(i))

    before = F.expr("aggregate(sequence(1, 5), 0, (s, i) -> s + if(i < step, "
                    "shiftleft(1, ascii(substring(filter_order, i, 1)) - ascii('A')), 0))")
    rows = rows.withColumn("_own", bit("step")).withColumn("_before", before).withColumn("_after", F.col("_before") + F.col("_own"))

    def gone(counts: str) -> Column:
        return F.get(counts, F.col("_before")) - F.get(counts, F.col("_after"))

    alone = F.get("total", F.lit(ALL) - F.col("_own")) - F.get("total", F.lit(ALL))
    failing = F.get("total", F.lit(0)) - F.get("total", F.col("_own"))
    return rows.select(
        "part", "filter_order", "step", F.get("total", F.col("_after")).alias("kept"), gone("total").alias("removed"),
        (failing - gone("total")).alias("redundant"), alone.alias("unique_fails"), gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.expr("get(_shapley, ascii(substring(filter_order, step, 1)) - ascii('A'))").alias("shapley"))
