"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation is learned on a bounded sample so that the signs of the rotated
principal components are balanced and lose little. The code is cut into
substrings, one table each; vectors that share a substring in some table (and
their label and size) are compared by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import complete_groups, components, cut_cells, forest, stored

CELL = 1024
KEYS = ["label", "size", "part", "sub"]


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): codes are the signs of (unit vector - mean) @ projection."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    _, vectors = np.linalg.eigh(np.cov((unit - mean).T, bias=True).reshape(unit.shape[1], -1))
    axes = vectors[:, ::-1][:, :bits]
    points = (unit - mean) @ axes
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        signs = np.where(points @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ points)
        rotation = (left @ right).T
    return mean, axes @ rotation


def learn(vectors: DataFrame, bits: int, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A rotation per vector size, from ``sample`` vectors or so of all sizes, chosen by a digest of their values."""
    total = vectors.count()
    if not total:
        return {}
    some = vectors.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 20)) < min(1.0, sample / total) * (1 << 20))
    rows = [r[0] for r in some.select("vector").limit(2 * sample).collect()]  # bounded by the parameter
    return {n: learn_rotation(np.array([r for r in rows if len(r) == n]), min(bits, n)) for n in {len(r) for r in rows}}


def _codes(unit: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    signs = (unit - model[0]) @ model[1] >= 0
    return (signs.astype(np.uint64) << np.arange(signs.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _cuts(bits: int, tables: int) -> list[tuple[int, int]]:
    tables = min(tables, bits)
    edges = [bits * i // tables for i in range(tables + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def index(vectors: DataFrame, models: dict, bits: int, tables: int) -> DataFrame:
    """(rep, label, size, part, sub, code, copies, vector): a row per vector and table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b["size"].to_numpy()
            for n in np.unique(sizes):
                t = b.filter(pa.array(sizes == n))
                n = int(n)
                data = t["vector"].flatten().to_numpy().reshape(-1, n)
                if n not in models:  # a size the sample didn't hold: a random rotation serves
                    turn = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))[0][:, :min(bits, n)]
                    models[n] = (np.zeros(n), turn)
                code = _codes(data / np.linalg.norm(data, axis=1, keepdims=True), models[n])
                for part, (low, high) in enumerate(_cuts(min(bits, n), tables)):
                    sub = (code >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [t["rep"], t["label"], t["size"], pa.array(np.full(len(code), part, np.int32)),
                         pa.array(sub.astype(np.int64)), pa.array(code.view(np.int64)), t["copies"], t["vector"]],
                        ["rep", "label", "size", "part", "sub", "code", "copies", "vector"])

    return vectors.select("rep", "label", "size", "copies", "vector").mapInArrow(
        run, "rep long, label string, size int, part int, sub long, code long, copies long, vector array<double>")


def _match(t: pa.Table, bits: int, tables: int, least: float) -> Iterator[pa.RecordBatch]:
    """Links and counts within one cell; a pair counts in the first table it shares."""
    n, part = t["size"][0].as_py(), t["part"][0].as_py()
    rep, code, copies = (t[c].to_numpy() for c in ("rep", "code", "copies"))
    vectors = t["vector"].combine_chunks().flatten().to_numpy().reshape(-1, n)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    own = t["_i"].to_numpy()
    i, j = t["_a"][0].as_py(), t["_b"][0].as_py()
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    if i == j and len(left) < 2 or not len(left) or not len(right):
        return
    close = unit[left] @ unit[right].T >= least
    if i == j:
        close &= rep[left][:, None] < rep[right][None, :]
    a, b = np.nonzero(close)
    a, b = left[a], right[b]
    apart = code[a].view(np.uint64) ^ code[b].view(np.uint64)
    first = np.ones(len(a), bool)
    for low, high in _cuts(min(bits, n), tables)[:part]:
        first &= (apart >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1) != 0
    a, b = a[first], b[first]
    if not len(a):
        return
    degree = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
    some = np.flatnonzero(degree)
    node, root = forest(rep[a], rep[b])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([node, rep[some]])),
         pa.array(np.concatenate([root, rep[some]])),
         pa.array(np.concatenate([np.zeros(len(node), np.int64), degree[some].astype(np.int64)]))], ["a", "b", "n"])


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def near_duplicates(rows: DataFrame, least: float = 0.98, bits: int = 64, tables: int = 8, sample: int = 4096,
                    cell: int = CELL, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row of ``rows``.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and
    those without a label, link with nothing. Equal vectors of a label are
    compared once and count as linked with each other. A null vec_id links but
    never names a component. Buckets of over ``cell`` vectors are cut into
    pieces, and each two pieces meet in a task of their own.
    """
    vector = F.col(vector_col).cast("array<double>")
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                       vector.alias("vector"))
    ok = _valid(F.col("vector")) & F.col("label").isNotNull()
    # scaled by the largest number, so that squares neither overflow nor vanish; -0.0 becomes 0.0
    top = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    scaled = F.when(ok, F.transform("vector", lambda x: x / top + 0.0))
    base = base.withColumn("vector", scaled).withColumn("rep", F.when(ok, F.xxhash64("label", "vector")))
    base = stored(base, "vectors")
    unique = (base.where(F.col("vector").isNotNull()).groupBy("label", "vector")
              .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min("rep").alias("rep"))
              .withColumn("size", F.size("vector")))
    unique = stored(unique, "unique")
    models = learn(unique, bits, sample)
    cells = cut_cells(index(unique, models, bits, tables), KEYS, "rep", cell)
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    cells = (cells.withColumn("_k", other).withColumn("_a", F.least("_i", "_k")).withColumn("_b", F.greatest("_i", "_k"))
             .drop("_k", "_n"))
    keys = [*KEYS, "_a", "_b"]
    cells = cells.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, keys):
            change = np.zeros(len(t), bool)
            for k in keys:
                c = t[k].to_numpy()
                change[1:] |= c[1:] != c[:-1]
            edges = np.concatenate([[0], np.flatnonzero(change), [len(t)]])
            for at in np.flatnonzero(np.diff(edges) > 1):
                yield from _match(t.slice(edges[at], edges[at + 1] - edges[at]), bits, tables, least)

    found = stored(cells.mapInArrow(run, "a long, b long, n long"), "found")
    group = components(found.select("a", "b"))
    degree = found.groupBy("a").agg(F.sum("n").alias("n"))
    named = (unique.join(degree, unique.rep == degree.a, "left").join(group, unique.rep == group.node, "left")
             .select("rep", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    top_id = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(top_id, "component").select("rep", "n_links", "component_id")
    linked = base.select("vec_id", "rep").join(named, "rep", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return linked.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
