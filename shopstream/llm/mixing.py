"""Mix sources to target weights by Pfair scheduling.

A source of weight w is cut into blocks of ``block`` documents. Its block j
(from 0) is released at slot floor(j / w) and due by slot ceil((j + 1) / w);
slots go to the released block that is due first. As long as every source has
blocks, after any number of slots each has had its share to within one block.

Weights are whole shares of one period, so the schedule repeats: one period is
worked out once by SQL functions, and each block finds its slot by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import digest, numbered, row_digest

REST = "*"


def schedule(spark: SparkSession, shares: dict[str, int]) -> DataFrame:
    """(mix_class, share, nth, turn): the slot of a class's nth block within a period of sum(shares) slots."""
    if not shares or any(not isinstance(s, int) or s < 1 for s in shares.values()):
        raise ValueError("shares must be whole numbers of 1 or more")
    names, period = list(shares), sum(shares.values())
    classes = F.array(*[F.lit(shares[n]) for n in names])

    def due_first(done: Column, slot: Column) -> Column:
        """Index of the released class whose next block is due first."""
        block = F.transform(classes, lambda share, i: F.struct(
            F.ceil((F.get(done, i) + 1) * period / share).alias("due"), i.alias("i"),
            (F.floor(F.get(done, i) * period / share) <= slot).alias("released")))
        return F.array_min(F.filter(block, lambda b: b.released)).i

    def turn(state: Column, slot: Column) -> Column:
        pick = due_first(state.done, slot)
        return F.struct(
            F.transform(state.done, lambda n, i: n + F.when(i == pick, 1).otherwise(0)).alias("done"),
            F.concat(state.picks, F.array(pick)).alias("picks"))

    start = F.struct(F.array_repeat(F.lit(0), len(names)).alias("done"), F.expr("cast(array() as array<int>)").alias("picks"))
    picks = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, turn, lambda s: s.picks)
    slots = spark.range(1).select(F.posexplode(picks).alias("turn", "i"))
    # at most one row per slot of the period, a parameter
    nth = F.row_number().over(Window.partitionBy("i").orderBy("turn")) - 1
    label = F.get(F.array(*[F.lit(n) for n in names]), F.col("i"))
    return slots.select(label.alias("mix_class"), F.get(classes, F.col("i")).alias("share"), nth.alias("nth"), "turn")


def mix(docs: DataFrame, shares: dict[str, int], block: int = 16, *, id_col: str = "doc_id",
        source_col: str = "source") -> DataFrame:
    """``docs`` with mix_class, block, slot, position (long, unique) and in_mix.

    Reading by ``position`` gives the mix. ``shares`` has whole shares by
    source; all other sources and null share the class ``*``, which takes the
    share given for it (without one: 1). Within a class documents come in the
    order of a digest of their id, then of the whole row: an even shuffle that
    any run repeats.
    in_mix: before the first class has run out of full blocks, so the weights
    hold; later positions leave out the slots of classes that are empty. No row
    is dropped. Repeated rows each get a position; an empty table stays empty.
    Columns of the same names are replaced.
    """
    shares = {REST: 1, **shares}
    period = sum(shares.values())
    plan = schedule(docs.sparkSession, shares)
    named = [n for n in shares if n != REST]
    source = F.col(source_col).cast("string")
    mix_class = F.when(source.isin(named), source).otherwise(F.lit(REST)) if named else F.lit(REST)
    new = ["mix_class", "block", "slot", "position", "in_mix"]
    keep = [c for c in docs.columns if c not in new]
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(id_col).alias("_id"), mix_class.alias("mix_class"),
                       digest(id_col).alias("_key"), row_digest(docs.select(*keep)).alias("_tie"))  # whatever the columns are called
    rows = numbered(rows, ["mix_class"], "_key", ["_id", "_tie"], "_index")

    blocks = rows.withColumn("block", F.floor(F.col("_index") / block))
    shares_of = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    blocks = (blocks.withColumn("_share", F.element_at(shares_of, F.col("mix_class")))
              .withColumn("_nth", F.pmod("block", "_share")))
    turns = plan.select(F.col("mix_class").alias("_class"), F.col("nth").alias("_turn_nth"), "turn")
    slot = F.floor(F.col("block") / F.col("_share")) * period + F.col("turn")
    placed = (blocks.join(turns, (F.col("mix_class") == F.col("_class")) & (F.col("_nth") == F.col("_turn_nth")))
              .withColumn("slot", slot)
              .withColumn("position", F.col("slot") * block + F.pmod("_index", F.lit(block))))
    placed = placed.withColumn("in_mix", F.col("slot") < _first_gap(docs, plan, shares, block, mix_class))
    return placed.select(*(F.col("_row")[c].alias(c) for c in keep), *new)


def _first_gap(docs: DataFrame, plan: DataFrame, shares: dict[str, int], block: int, mix_class: Column) -> Column:
    """The first slot whose class has no full block left; one row per class reaches the driver."""
    counts = docs.select(mix_class.alias("mix_class")).groupBy("mix_class").count()
    full = F.floor(F.coalesce("count", F.lit(0)) / block)
    missing = (plan.join(counts, "mix_class", "left").where(F.col("nth") == F.pmod(full, F.col("share")))
               .select((F.floor(full / F.col("share")) * sum(shares.values()) + F.col("turn")).alias("slot")))
    return F.lit(missing.agg(F.min("slot")).first()[0])
