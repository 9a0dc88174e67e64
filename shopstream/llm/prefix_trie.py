"""The trie of conversation prefixes, without shuffling what only one conversation has.

A prefix is known by a 128-bit digest: the sum of digests of its turns, each
taken with its place. A count-min sketch of all prefixes, of bounded size, is
sent to every executor; an estimate of one proves that a prefix belongs to a
single conversation, and so does everything after it, so these tails give
their nodes on the spot. Only the other prefixes are grouped exactly.

Sums over subtrees need no walk: a node is named by its smallest member, and
the nodes named by one conversation are the end of its path. So a conversation
hands the total of its own nodes to each node above them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WHITE, stored

GROUP = 20         # conversations that start alike
PIECE = 4096       # turns of one conversation, or ids of one node, taken together
HASHES = 4         # rows of the sketch
LEAST, MOST = 1 << 12, 1 << 24  # cells of a row
BLOCK = 1 << 13    # cells that travel together
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
       0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]
KEY, PARENT = ["k0", "k1"], ["p0", "p1"]
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_key, words): each conversation's turns from 1 on, by turn (null first), then by their digest.

    Rows are dealt by range, so a conversation of very many turns spans
    several tasks; a row's number is its number there plus the rows of the
    tasks before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    words = F.size(F.filter(F.split(text, WHITE), lambda w: w != "")).cast("long")
    base = stored(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", F.unhex(whole).alias("turn_key"), words.alias("words")), "turns")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "turn_key"]
    dealt = stored(base.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_task", F.spark_partition_id()), "turns-in-order")
    before = Window.partitionBy("conv_id").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("conv_id", "_task").agg(F.count(F.lit(1)).alias("_n"))
              .select("conv_id", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")).where("_start > 0"))
    inside = Window.partitionBy("conv_id", "_task").orderBy(F.col("turn").asc_nulls_first(), "turn_key")
    return (dealt.withColumn("_n", F.row_number().over(inside)).join(stored(starts, "starts"), ["conv_id", "_task"], "left")
            .select("conv_id", (F.col("_n") + F.coalesce("_start", F.lit(0))).alias("pos"), "turn_key", "words"))


def running(rows: DataFrame, order: str, values: list[str]) -> DataFrame:
    """``values`` summed up to and with each row of its conversation, in ``order`` (long), by pieces of PIECE."""
    rows = rows.withColumn("_piece", F.floor(F.col(order) / PIECE))
    before = Window.partitionBy("conv_id").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "_piece").agg(*[F.sum(v).alias(v) for v in values])
    starts = sums.select("conv_id", "_piece", *[F.sum(v).over(before).alias(f"_{v}") for v in values]).where(F.col(f"_{values[0]}").isNotNull())
    within = Window.partitionBy("conv_id", "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({v: F.sum(v).over(within) for v in values}).join(stored(starts, "starts"), ["conv_id", "_piece"], "left")
    return rows.withColumns({v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values}).drop("_piece", *[f"_{v}" for v in values])


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, words, size, k0, k1, p0, p1): every prefix of every rebuilt conversation.

    ``size`` is the number of rebuilt turns, k0 and k1 are the digest of the
    prefix, p0 and p1 of the one before (null at depth 0).
    """
    own = stored(turns(conversations), "numbered")
    first = F.when(F.col("pos") < 4, F.struct("pos", "turn_key", "words"))
    convs = stored(own.groupBy("conv_id").agg(F.max("pos").alias("n"), F.sort_array(F.collect_list(first)).alias("head")), "heads")
    heads = convs.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("donor"), F.col("head").alias("given"))
    some = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    convs = (convs.withColumn("donor", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "donor", "left")
             .withColumn("h", some).withColumn("k", F.least("h", F.coalesce(F.size("given"), F.lit(0))))
             .withColumn("size", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
             .select("conv_id", "h", "k", "size", F.expr("slice(given, 1, cast(k as int))").alias("given")))
    convs = stored(convs, "plans")
    theirs = convs.select("conv_id", "size", F.explode("given").alias("g")).select(
        "conv_id", F.col("g.pos").alias("depth"), "g.turn_key", "g.words", "size")
    rest = (own.join(convs, "conv_id").where("pos > h")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "turn_key", "words", "size"))
    lanes = [f"l{i}" for i in range(4)]
    at = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("turn_key")).cast("binary"), 256)
    rows = theirs.union(rest).withColumn("_at", at).drop("turn_key")
    for i, lane in enumerate(lanes):
        rows = rows.withColumn(lane, F.conv(F.substring("_at", 1 + 8 * i, 8), 16, 10).cast("long"))
    rows = rows.withColumns({f"o{i}": F.col(lane) for i, lane in enumerate(lanes)}).drop("_at")
    rows = running(rows, "depth", lanes)

    def key(a: Column, b: Column) -> Column:
        low = F.lit(0xFFFFFFFF)
        return F.shiftleft(a.bitwiseAND(low), 32).bitwiseOR(b.bitwiseAND(low))

    now, last = [F.col(lane) for lane in lanes], [F.col(lane) - F.col(f"o{i}") for i, lane in enumerate(lanes)]
    rows = rows.select("conv_id", F.col("depth").cast("long"), "words", F.col("size").cast("long"), key(now[0], now[1]).alias("k0"),
                       key(now[2], now[3]).alias("k1"), key(last[0], last[1]).alias("p0"), key(last[2], last[3]).alias("p1"))
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    return rows.union(convs.select("conv_id", zero, zero, F.col("size").cast("long"), zero, zero, null, null))


def _cells(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """(HASHES, rows): the cell of each prefix in each row of the sketch."""
    a, b = (batch[c].to_numpy().view(np.uint64) for c in KEY)
    shift = np.uint64(64 - (width.bit_length() - 1))
    return np.stack([((a ^ (a >> np.uint64(31))) * np.uint64(ODD[2 * i]) + b * np.uint64(ODD[2 * i + 1])) >> shift
                     for i in range(HASHES)]).astype(np.int64)


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """(HASHES, width) booleans: cells that hold two prefixes or more.

    Counters stop at two. Each task counts its rows, blocks of counters meet
    by number, and only their bits for 'two or more' come to the driver: at
    most HASHES * MOST / 8 bytes.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = np.zeros((HASHES, width), np.uint8), False
        for batch in batches:
            some = some or batch.num_rows > 0
            for row, cells in zip(counts, _cells(batch, width), strict=True):
                cell, n = np.unique(cells, return_counts=True)
                row[cell] = np.minimum(2, row[cell] + n)
        blocks = counts.reshape(-1, BLOCK if width >= BLOCK else width)
        for low in range(0, len(blocks) if some else 0, 256):
            part = blocks[low:low + 256]
            kept = np.flatnonzero(part.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept + low), pa.array([np.packbits(part[i] > 0).tobytes() for i in kept], pa.binary()),
                 pa.array([np.packbits(part[i] > 1).tobytes() for i in kept], pa.binary())], ["block", "one", "two"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, one, two = None, None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([two.tobytes()], pa.binary())], ["block", "two"])

        for batch in batches:
            for b, x, y in zip(batch["block"].to_pylist(), batch["one"], batch["two"], strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint8), np.frombuffer(y.as_py(), np.uint8)
                if b != block:
                    if block is not None:
                        yield out()
                    block, one, two = b, x, y
                else:
                    one, two = one | x, two | y | (one & x)
        if block is not None:
            yield out()

    blocks = rows.select(*KEY).mapInArrow(count, "block long, one binary, two binary")
    found = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(combine, "block long, two binary").collect()
    bits = np.zeros((HASHES * width // min(BLOCK, width), min(BLOCK, width) // 8), np.uint8)
    for r in found:
        bits[r.block] = np.frombuffer(r.two, np.uint8)
    return bits.reshape(HASHES, -1)


def screened(rows: DataFrame, spark: SparkSession, most: int = MOST) -> DataFrame:
    """``rows`` with top: the depth from which the conversation is alone, by the sketch (null: nowhere proved)."""
    n = rows.count()
    width = min(most, max(LEAST, 1 << (2 * n).bit_length()))
    bits = spark.sparkContext.broadcast(sketch(rows, width))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _cells(batch, width)
            shared = np.ones(batch.num_rows, bool)
            for row, cell in zip(bits.value, cells, strict=True):
                shared &= row[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1 == 1
            yield batch.select(["conv_id", "depth"]).filter(pa.array(~shared))

    found = rows.select("conv_id", "depth", *KEY).mapInArrow(alone, "conv_id long, depth long")
    return rows.join(stored(found.groupBy("conv_id").agg(F.min("depth").alias("top")), "tops"), "conv_id", "left")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(k0, k1, ends): SHA-256 of each node's ids, ascending and comma-joined, from rows (k0, k1, conv_id).

    Ids are packed by range first, so the task that digests a node of very
    many ids reads few rows, one after the other.
    """
    order = [*KEY, "conv_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a, k, ids = (b[c].to_numpy() for c in order)
            new = np.flatnonzero((a[1:] != a[:-1]) | (k[1:] != k[:-1])) + 1
            edges = np.unique(np.concatenate([[0], new, np.arange(0, len(ids), PIECE), [len(ids)]]))
            texts = [",".join(map(str, ids[i:j].tolist())).encode() for i, j in zip(edges[:-1], edges[1:], strict=True)]
            at = edges[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(k[at]), pa.array(ids[at]), pa.array(texts, pa.binary())],
                                             [*KEY, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done = []
            for a, k, ids in zip(b["k0"].to_pylist(), b["k1"].to_pylist(), b["ids"], strict=True):
                if (a, k) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, k), hashlib.sha256(ids.as_py())
                else:
                    state.update(b"," + ids.as_py())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*KEY, "ends"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node[0]]), pa.array([node[1]]), pa.array([state.hexdigest()])], [*KEY, "ends"])

    packed = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pack, "k0 long, k1 long, first long, ids binary")
    return packed.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, "k0 long, k1 long, ends string")


def trie(conversations: DataFrame, most_cells: int = MOST) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conv_id belong to no conversation and are left out; null
    role and text are empty. Turns of one number are ordered by their digest;
    repeated rows are turns of their own. An empty table has no conversations
    and so no nodes. Texts of any length are digested whole; other columns are
    left out. ``most_cells`` bounds the sketch: past some ``most_cells`` / 2
    prefixes more of them are grouped exactly, and the result is the same.
    """
    spark = conversations.sparkSession
    rows = stored(screened(stored(rebuilt(conversations), "prefixes"), spark, most_cells), "screened")
    shared = rows.where("top is null or depth < top")
    ends = F.col("depth") == F.col("size")
    nodes = stored(shared.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("depth").alias("depth"),
        F.first("p0").alias("p0"), F.first("p1").alias("p1"), F.first("words").alias("words"),
        F.sum(ends.cast("long")).alias("n_ends"), F.min(F.when(ends, F.col("conv_id"))).alias("end")), "nodes")
    tops = rows.where("depth = top")
    children = nodes.select(*PARENT).union(tops.select(*PARENT)).where("p0 is not null").groupBy(
        F.col("p0").alias("k0"), F.col("p1").alias("k1")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(stored(children, "children"), KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))

    # what a conversation's own nodes hold below and with each of them, and its whole total
    tail = tops.select(F.col("conv_id"), F.lit(1).cast("long").alias("tail"), "top")
    leaf = (F.col("n_children") == 0).cast("long")
    own = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).withColumn("leaves", leaf)
    own = stored(own.withColumn("_up", -F.col("depth")), "own")
    summed = running(own.select("conv_id", "_up", *KEY, "saved", "leaves"), "_up", ["saved", "leaves"])
    total = (own.groupBy("conv_id").agg(F.sum("saved").alias("t_saved"), F.sum("leaves").alias("t_leaves"), F.min("depth").alias("since"))
             .join(tail, "conv_id", "full").select(
                 "conv_id", F.coalesce("t_saved", F.lit(0)).alias("t_saved"), F.coalesce("tail", F.lit(0)).alias("tail"),
                 (F.coalesce("t_leaves", F.lit(0)) + F.coalesce("tail", F.lit(0))).alias("t_leaves"), F.coalesce("since", "top").alias("since")))
    total = stored(total, "totals")
    above = (shared.join(total.where("t_saved > 0 or t_leaves > 0"), "conv_id").where("depth < since").groupBy(*KEY)
             .agg(F.sum("t_saved").alias("a_saved"), F.sum("t_leaves").alias("a_leaves")))
    summed = (summed.join(total.select("conv_id", "tail"), "conv_id").join(stored(above, "above"), KEY, "left").select(
        *KEY, (F.col("saved") + F.coalesce("a_saved", F.lit(0))).alias("saved_tokens"),
        (F.col("leaves") + F.col("tail") + F.coalesce("a_leaves", F.lit(0))).alias("n_leaves")))

    several = stored(own.where("n_ends > 1").select(*KEY), "several")
    hashes = ends_digests(stored(shared.where(ends).select(*KEY, "conv_id").join(several, KEY), "ends"))
    few = F.when(F.col("n_ends") == 0, F.lit(EMPTY)).otherwise(F.sha2(F.col("end").cast("string").cast("binary"), 256))
    named = stored(own.join(stored(summed, "summed"), KEY).join(stored(hashes, "hashes"), KEY, "left")
                   .withColumn("ends_sha256", F.coalesce("ends", few)), "named")

    parent = named.select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    last = F.when(ends, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY))
    alone = rows.where("depth >= top").select(
        "conv_id", "depth", *PARENT, F.col("top"), one.alias("n_convs"), (~ends).cast("long").alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved_tokens"), last.alias("ends_sha256"))
    # the inside of a tail knows its parent; the tops and the exact nodes look theirs up
    inside = alone.where("depth > top").withColumn("parent_conv_id", F.col("conv_id"))
    hung = named.select("conv_id", "depth", *PARENT, "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").union(
        alone.where("depth = top").drop("top"))
    hung = stored(hung, "hung").join(parent, PARENT, "left")
    return hung.select(*out).union(inside.select(*out))
