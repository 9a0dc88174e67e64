"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``points`` places on a ring of digests. A document starts at
the first place clockwise of its own digest; where that shard is full it goes
on clockwise to the next shard with room. Room is counted in rows: with
``load`` 1 a shard takes its equal quota and counts differ by one at most;
a larger load moves fewer documents when shards change.
"""

from __future__ import annotations

import bisect
import hashlib
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, numbered, stored


def ring(shards: int, points: int) -> list[tuple[str, int]]:
    """(digest, shard) of every place, in ring order."""
    return sorted((hashlib.md5(f"{s}/{p}".encode()).hexdigest(), s) for s in range(shards) for p in range(points))


def _fill(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first, last + 1, shard, slot of first): which rows of an arc each shard takes.

    Arcs are served in ring order. Bounded by places and shards, both
    parameters: rows themselves are never seen here.
    """
    used, taken = [0] * len(room), []
    for arc in sorted(counts):
        first, at = 0, arc
        while first < counts[arc]:
            shard = owners[at % len(owners)]
            n = min(counts[arc] - first, room[shard] - used[shard])
            if n:
                taken.append((arc, first, first + n, shard, used[shard]))
                used[shard] += n
                first += n
            at += 1
    return taken


def assign(docs: DataFrame, shards: int = 40, points: int = 64, load: float = 1.0, *, id_col: str = "doc_id",
           ties: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with shard (int) and slot (long, gapless from 0 in each shard).

    Null and repeated ids all start at one place and overflow from there;
    ``ties`` are columns that order rows of one id. An empty table stays empty.
    Columns called shard or slot are replaced.
    """
    if shards < 1 or points < 1 or load < 1:
        raise ValueError("shards, points and load must be 1 or more")
    spark = docs.sparkSession
    places = ring(shards, points)
    heads = F.array(*[F.lit(h) for h, _ in places])
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(id_col).alias("_id"), digest(id_col).alias("_key"))
    # binary search by halving steps; past the end, get() is null and the step is not taken
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(places).bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.get(heads, low + step - 1) < F.col("_key"), low + step).otherwise(low))
    rows = rows.withColumn("_arc", F.pmod(below, F.lit(len(places))))
    # a second digest, of id and ties, deals the rows of one arc into pieces
    spread = F.md5(F.concat_ws("/", F.col("_key"), *[F.col("_row")[c].cast("string") for c in ties]).cast("binary"))
    counts = {r["_arc"]: r["count"] for r in rows.groupBy("_arc").count().collect()}  # one row per place
    rows = numbered(rows.withColumn("_key", spread), ["_arc"], "_key", ["_id", *(f"_row.{c}" for c in ties)], "_rank")
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)] if load == 1 else [
        ceil(load * total / shards)] * shards
    parts = _fill(counts, [s for _, s in places], room)
    plan = spark.createDataFrame(parts or [(0, 0, 0, 0, 0)], "_part long, _first long, _end long, shard int, _slot long")
    # places + shards rows at most, so small enough for every executor
    inside = (F.col("_arc") == F.col("_part")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    return (rows.join(F.broadcast(plan), inside)
            .select(*(F.col("_row")[c].alias(c) for c in keep), "shard",
                    (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot")))
