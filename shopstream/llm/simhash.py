"""Near-duplicate texts by SimHash fingerprints, linked exactly through anchors of a covering code.

64 bits are cut into ``blocks`` parts. Two fingerprints that differ in at most
``near`` bits differ in at most near // blocks of some part. The anchors of a
part are the words of a covering code of radius 1: a perfect Hamming code on
the first 2^r - 1 bits and every value of the rest. A fingerprint goes to all
anchors within 1 + near // blocks of its part, and so also to the anchor next
to any fingerprint it may link with. Per anchor, the fingerprints next to it
are compared with all that came. No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import complete_groups, components, cut_cells, forest, row_digest, stored

BITS = 64
CELL = 2048
PAIRS = 1 << 20
KEYS = ["part", "anchor", "cell"]


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of ``width`` words, or of all words if there are fewer."""
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1:].tolist()
    return np.array([xxhash.xxh64_intdigest(whole[a:b], 42) for a, b in zip(starts[:n].tolist(), last, strict=True)], "<u8")


def _majority(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit word whose bits are those set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")


def fingerprint(text: str | None, width: int) -> int:
    """SimHash of the lower-cased (A-Z) shingles of ``width`` words, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    return int(_majority(_hashes(words, width)).view("<i8")[0]) if words else 0


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, _text, node): one row per row of ``docs``; ``_text`` is a digest of the text, ``node`` its fingerprint."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = pa.array([fingerprint(t, width) for t in b["text"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["_text"], prints], ["doc_id", "_text", "node"])

    return rows.mapInArrow(run, "doc_id long, _text long, node long")


class Code:
    """Covering code of radius 1 on ``width`` bits, and the moves from a word to the anchors within ``reach``."""

    def __init__(self, width: int, reach: int):
        self.width = width
        self.checked = 2 ** ((width + 1).bit_length() - 1) - 1
        by_syndrome: dict[int, list[int]] = {s: [] for s in range(self.checked + 1)}
        for weight in range(reach + 1):
            for bits in combinations(range(width), weight):
                s = 0
                for b in bits:
                    s ^= b + 1 if b < self.checked else 0
                by_syndrome[s].append(sum(1 << b for b in bits))
        most = max(map(len, by_syndrome.values()))
        self.count = np.array([len(by_syndrome[s]) for s in sorted(by_syndrome)])
        self.moves = np.zeros((len(by_syndrome), most), np.uint64)
        for s, masks in by_syndrome.items():
            self.moves[s, :len(masks)] = masks

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for b in range(self.checked):
            out ^= ((words >> np.uint64(b)) & np.uint64(1)).astype(np.int64) * (b + 1)
        return out

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the word, anchor, whether the anchor is the word's nearest)."""
        s = self.syndromes(words)
        n = self.count[s]
        at = np.repeat(np.arange(len(words)), n)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        move = self.moves[s[at], nth]
        nearest = np.where(s == 0, np.uint64(0), np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64))
        return at, words[at] ^ move, move == nearest[at]


def _widths(blocks: int) -> list[int]:
    return [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]


def replicate(uniq: DataFrame, near: int, blocks: int) -> DataFrame:
    """(part, anchor, node, home) for every anchor a fingerprint (node) goes to."""
    widths = _widths(blocks)
    codes = {w: Code(w, 1 + near // blocks) for w in set(widths)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                rows, low = b.slice(at, 2048), 0
                words = rows["node"].to_numpy().view(np.uint64)
                for part, w in enumerate(widths):
                    i, anchor, home = codes[w].anchors((words >> np.uint64(low)) & np.uint64((1 << w) - 1))
                    low += w
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(i), part, np.int32)), pa.array(anchor.view(np.int64)),
                         pa.array(words[i].view(np.int64)), pa.array(home)], ["part", "anchor", "node", "home"])

    return uniq.select("node").mapInArrow(run, "part int, anchor long, node long, home boolean")


def _compare(t: pa.Table, near: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the pairs (home, visitor) of each cell of a sorted table."""
    change = np.zeros(len(t), bool)
    for k in KEYS:
        c = t[k].to_numpy()
        change[1:] |= c[1:] != c[:-1]
    starts = np.concatenate([[0], np.flatnonzero(change)])
    lengths = np.diff(np.append(starts, len(t)))
    start, length = np.repeat(starts, lengths), np.repeat(lengths, lengths)
    homes = np.flatnonzero(t["home"].to_numpy() & (length > 1))
    node = t["node"].to_numpy()
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(homes):
        sizes = length[homes[at:]]
        n = max(1, int(np.searchsorted(np.cumsum(sizes), PAIRS)))
        some, sizes = homes[at:at + n], sizes[:n]
        at += n
        a = np.repeat(some, sizes)
        b = np.repeat(start[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(a))
        linked = (node[a] < node[b]) & (np.bitwise_count((node[a] ^ node[b]).view(np.uint64)) <= near)
        a, b = a[linked], b[linked]
        if len(a):
            found.append(forest(node[a], node[b]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(*map(np.concatenate, zip(*found, strict=True)))


def links(uniq: DataFrame, near: int, blocks: int, cell: int = CELL) -> DataFrame:
    """(a, b): links that span every group of the distinct fingerprints (node).

    Two link if at most ``near`` bits apart. An anchor of more than ``cell``
    fingerprints is cut into pieces, and each piece of its nearest ones meets
    each piece of all in a task of its own.
    """
    rows = cut_cells(replicate(uniq, near, blocks), ["part", "anchor"], "node", cell)
    sides = (F.when(~F.col("home"), F.lit("visit")).when(F.col("_n") == 1, F.lit("home"))
             .otherwise(F.lit("home,visit")))  # in an uncut cell, the nearest ones meet each other as they are
    rows = (rows.withColumn("side", F.explode(F.split(sides, ",")))
            .withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
            .withColumn("home", F.col("side") == "home")
            .withColumn("cell", F.when(F.col("home"), F.col("_i") * F.col("_n") + F.col("_k"))
                        .otherwise(F.col("_k") * F.col("_n") + F.col("_i"))))
    rows = rows.select(*KEYS, "node", "home").repartition(*KEYS).sortWithinPartitions(*KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, KEYS):
            a, b = _compare(t, near)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, width: int, near: int, blocks: int) -> DataFrame:
    """(doc_id, _text, node, component, component_id), one row per row of ``docs``.

    ``component`` is the smallest fingerprint of the group. The sizes of the
    stored tables decide the joins, and Spark can split a group that is hot.
    """
    rows = stored(fingerprints(docs, width), "fingerprints")
    uniq = stored(rows.groupBy("node").agg(F.min("doc_id").alias("least")), "distinct")
    group = components(links(uniq, near, blocks)).withColumnRenamed("node", "_node")
    named = stored(uniq.join(group, F.col("node") == F.col("_node"), "left").select(
        "node", "least", F.coalesce("component", "node").alias("component")), "named")
    least = stored(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    return rows.join(named.join(least, "component").select("node", "component", "component_id"), "node")


def near_duplicates(docs: DataFrame, width: int = 4, near: int = 4, blocks: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links, itself included;
    null ids are linked but never name a component (null if there is no other).
    Texts without words, null and empty ones among them, have fingerprint zero.
    Equal fingerprints are compared once. Texts of any length pass; an empty
    table gives none. Other columns of ``docs`` are left out.
    """
    digits = F.lpad(F.lower(F.hex("node")), 16, "0")
    return groups(docs, width, near, blocks).select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 4, near: int = 4, blocks: int = 3) -> DataFrame:
    """``docs`` with one row of every group of ``near_duplicates``: that of the smallest doc_id.

    Where rows share the smallest id, the smallest text digest decides, then
    the digest of all columns; a group whose ids are all null keeps one row by
    the same digests. All texts without words are linked like any other: they
    are one group. An empty table stays empty. Other columns are kept.
    """
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    best = (groups(docs, width, near, blocks).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("component").agg(F.first(name).alias("_id"), F.min("_text").alias("_of")).select("_id", "_of"))
    rows = docs.select(F.struct("*").alias("_row"), name.alias("_id"), F.xxhash64("text").alias("_of"), row_digest(docs).alias("_tie"))
    # the window needs no shuffle of its own after the join: the keys are the same
    nth = F.row_number().over(Window.partitionBy("_id", "_of").orderBy("_tie"))
    kept = rows.join(best, ["_id", "_of"], "left_semi").withColumn("_nth", nth).where("_nth = 1")
    return kept.select(*(F.col("_row")[c].alias(c) for c in docs.columns))
