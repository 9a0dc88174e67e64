"""One row per key.

Both forms filter on ``row_number() = 1``. Spark pushes that limit below the
shuffle (WindowGroupLimit), so each map task sends at most one row per key and
a key that holds a third of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Order = Sequence[Column | str]


def _top(df: DataFrame, keys: Sequence[str | Column], order: Order) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def first_by_key(df: DataFrame, keys: Sequence[str | Column], order: Order) -> DataFrame:
    """Keep the first row of each key. ``order`` must be unique within a key."""
    return _top(df, keys, order)


def last_by_key(df: DataFrame, keys: Sequence[str | Column], version: str, arrival: Order) -> DataFrame:
    """Keep the row with the highest ``version``; on ties the latest arrival."""
    newest = [F.col(version).desc_nulls_last()]
    newest += [(F.col(c) if isinstance(c, str) else c).desc() for c in arrival]
    return _top(df, keys, newest)
