"""First-of-day, first-ever and returning flags.

A flag depends only on the earliest time per (key, day), so rows are reduced
to that with a partial hash aggregate before anything is shuffled. What is
left per key is at most one row per day; only that is ordered by a window.
Input is taken as ordered by time: a day counts once per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopstream.operators.dedup import first_by_key


def daily_first(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Earliest time of each key on each day: ``keys, dt, <time>``."""
    return df.groupBy(*keys, F.to_date(time).alias("dt")).agg(F.min(time).alias(time))


def with_first_ever(firsts: DataFrame, key: str) -> DataFrame:
    """Add ``is_first_ever`` to the output of :func:`daily_first`."""
    days = Window.partitionBy(key)
    return firsts.withColumn("is_first_ever", F.col("dt") == F.min("dt").over(days))


def with_returning(firsts: DataFrame, key: str, days: int = 8) -> DataFrame:
    """Add ``is_back``: at least ``days`` days passed since the key's last day."""
    previous = F.lag("dt").over(Window.partitionBy(key).orderBy("dt"))
    return firsts.withColumn("is_back", F.coalesce(F.datediff("dt", previous) >= days, F.lit(False)))


def flag_rows(df: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """Every input row with ``is_daily_first`` (first of its key's day) and
    ``is_first_ever`` (first of its key). ``(time, tie)`` must be unique within a key.

    The earliest times, and the smallest tie at each, are found by map-side
    combined aggregates over plain values and joined back on (key, time, tie).
    That join key is unique per row, so the rows of a hot key spread over all
    tasks.
    """
    times = with_first_ever(daily_first(df, [key], time), key).drop("dt")
    ties = df.groupBy(key, time).agg(F.min(tie).alias(tie))
    firsts = ties.join(times, [key, time]).select(
        key, time, tie, F.lit(True).alias("is_daily_first"), "is_first_ever")
    no = F.lit(False)
    return df.join(firsts, [key, time, tie], "left").withColumns({
        "is_daily_first": F.coalesce("is_daily_first", no), "is_first_ever": F.coalesce("is_first_ever", no),
    })


def unique_visitors(pages: DataFrame, tie: str, key: str = "mid", time: str = "rt") -> DataFrame:
    """Entry pages (no previous page), first per visitor and day."""
    entries = pages.where("last_page_id is null")
    return first_by_key(entries, [key, F.to_date(time)], [time, tie])
