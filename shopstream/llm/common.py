"""Helpers the corpus operators share: stored tables, row numbers, complete groups, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstream.session import shared_dir

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: lineage ends there."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Bound what a Python worker holds at once: this many rows and bytes of whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def digest(column: str) -> Column:
    """md5 of a column's text form as 32 hex digits; null has a digest of its own."""
    return F.md5(F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null")).cast("binary"))


def row_digest(df: DataFrame) -> Column:
    """64-bit digest of all columns that Spark can digest (maps are left out), to order rows that are else alike."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def numbered(df: DataFrame, group: list[str], key: str, ties: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... within ``group`` in the order of the hex digest ``key``.

    A group is cut by the first three digits of the key, so no task sorts a
    whole group: rows are numbered per piece and shifted by the sizes of the
    pieces before it.
    """
    df = df.withColumn("_piece", F.substring(key, 1, 3))
    same = [*group, "_piece"]
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(*same).agg(F.count(F.lit(1)).alias("_n"))
              .select(*same, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = F.row_number().over(Window.partitionBy(*same).orderBy(key, *ties)) - 1
    return (df.withColumn(name, within).join(starts, same)
            .withColumn(name, F.col(name) + F.col("_start")).drop("_piece", "_start"))


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from sorted batches; only the last, open group waits for the next batch."""
    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        last = [table[k][-1] for k in keys]
        same = np.ones(table.num_rows, bool)
        for k, value in zip(keys, last, strict=True):
            same &= pc.equal(table[k], value).to_numpy()
        cut = int(np.argmax(same)) if same.any() else 0
        if cut:
            yield pa.concat_tables([*waiting, table.slice(0, cut)]).combine_chunks()
            waiting = [table.slice(cut)]
        elif waiting and any(waiting[-1][k][-1] != v for k, v in zip(keys, last, strict=True)):
            yield pa.concat_tables(waiting).combine_chunks()
            waiting = [table]
        else:
            waiting.append(table)
    if waiting:
        yield pa.concat_tables(waiting).combine_chunks()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to (node, smallest node reachable), without the smallest nodes themselves."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[:len(a)], inverse[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        after = root.copy()
        np.minimum.at(after, root[x], low)
        np.minimum.at(after, root[y], low)
        after = after[after]
        if (after == root).all():
            moved = root != np.arange(len(nodes))
            return nodes[moved], nodes[root[moved]]
        root = after


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b: long); component is the smallest node reachable.

    Alternating stars: each round hangs the larger neighbours of a node on its
    smallest neighbour, then the smaller ones. Every round is written to the
    shared folder; the end is two rounds with the same links. The smallest
    neighbours are written too: a join with a stored table deals both sides
    itself, so Spark can split a node with very many links.
    """
    low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    now = stored(links.where("a <> b").select(high, low).distinct(), "links")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b"), F.col("b")).distinct())
        mark = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = stored(large.distinct(), "large-star")
        floor = stored(large.groupBy("a").agg(F.min("b").alias("m")), "floor")
        small = large.join(floor, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(floor.select("a", F.col("m").alias("b")).union(small).distinct(), "links")


def cut_cells(rows: DataFrame, keys: list[str], spread: str, limit: int) -> DataFrame:
    """Add ``_i`` and ``_n``: groups of over ``limit`` rows get ``_n`` pieces, each row in piece ``_i``.

    The large groups are few (rows / limit), stored, and joined by whatever
    plan their size allows.
    """
    large = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
                   .withColumn("_n", F.ceil(F.col("_n") / limit).cast("int")), "large")
    return (rows.join(large, keys, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
            .withColumn("_i", F.expr(f"cast(pmod(xxhash64({spread}), _n) as int)")))
