"""Keyed state on streams, all of it on Spark's own stateful operators.

First rows are aggregates in update mode. A group also keeps the time of the
micro-batch it was born in, and only groups born in the present one are given
out: each first row comes once, at once, and a retried micro-batch, which has
the same time, gives it again. Such streams are landed batch by batch
(:func:`shopstream.sources.sinks.to_batches`). Map-side combine makes a key
with very many rows cost no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.operators.logs import in_slots

EVER = 3650  # days: longer than any shop's history


def first_arrivals(df: DataFrame, keys: Sequence[str], time: str, horizon: str) -> DataFrame:
    """Drop rows whose key was seen within ``horizon`` of event time."""
    return df.withWatermark(time, horizon).dropDuplicatesWithinWatermark(list(keys))


def last_versions(
    df: DataFrame, keys: Sequence[str], version: str, hold: str = "5 seconds", delay: str = "2 seconds",
    ties: Sequence[Column | str] = (),
) -> DataFrame:
    """Newest version per key, given out once no further version came for ``hold``.

    ``version`` is a timestamp and serves as the event time of the session;
    of versions of one time the highest ``ties`` count.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(version, *ties)).alias("_row")
    sessions = df.withWatermark(version, delay).groupBy(*keys, F.session_window(version, hold)).agg(newest)
    return sessions.select(*keys, "_row.*")


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], time: str = "rt", every: str | None = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """First row per key and day, in update mode.

    Within a micro-batch the first in ``order`` counts, over micro-batches the
    first to arrive. State of a day is dropped once the watermark, ``delay``
    behind the newest row, is past it; rows that come later than that are
    left out, as are rows without a time. With ``every`` None a key counts
    once for good, and its state stays.
    """
    groups = [F.col(k) for k in keys]
    if every is not None:
        df = df.withWatermark(time, delay)
        groups.append(F.window(time, every))
    row = F.struct(*[F.col(c).alias(c) for c in df.columns])
    born = df.withColumn("_now", F.current_timestamp()).groupBy(*groups).agg(
        F.min_by(row, F.struct(*order)).alias("_row"), F.min("_now").alias("_born"))
    return born.where(F.col("_born") == F.current_timestamp()).select("_row.*")


def with_history(
    firsts: DataFrame, key: str, time: str = "rt", memory_days: int = EVER, back_days: int = 8, delay: str = "1 day",
) -> DataFrame:
    """Add ``is_first_ever`` and ``is_back`` to first rows per key and day, in update mode.

    The days a key was seen on are remembered for ``memory_days``: "ever" is
    within that many days before, and so is the last day that ``is_back``
    counts from. A day is looked at in a window that reaches back that far at
    least; windows last twice as long and overlap by half, so state is dropped
    after three times ``memory_days`` at the most. A late day is compared with
    the days before it.
    """
    day = F.to_date(time)
    seen = F.struct(day.alias("day"), F.col("_now").alias("born"), F.struct(*[F.col(c).alias(c) for c in firsts.columns]).alias("row"))
    spans = F.window(time, f"{2 * memory_days} days", f"{memory_days} days").alias("_span")
    kept = (firsts.withWatermark(time, delay).withColumn("_now", F.current_timestamp()).groupBy(key, spans)
            .agg(F.collect_list(seen).alias("_days")).withColumn("_now", F.current_timestamp()))
    half = F.date_add(F.to_date(F.col("_span.start")), memory_days)
    new = F.filter("_days", lambda x: (x.born == F.col("_now")) & (x.day >= half))

    def before(x: Column) -> Column:
        return F.array_max(F.transform(
            F.filter("_days", lambda y: (y.day < x.day) & (y.day >= F.date_sub(x.day, memory_days))), lambda y: y.day))

    flagged = F.transform(new, lambda x: F.struct(x.row.alias("row"), x.day.alias("day"), before(x).alias("last")))
    back = F.coalesce(F.datediff("day", "last") >= back_days, F.lit(False))
    return kept.select(F.inline(flagged)).select("row.*", F.col("last").isNull().alias("is_first_ever"), back.alias("is_back"))


def bounces(
    df: DataFrame, tie: str, within_ms: int = 10_000, delay: str = "2 seconds", key: str = "mid", ts: str = "ts",
    time: str = "rt", slots: int = 360,
) -> DataFrame:
    """Entry pages not followed within the limit by a page of the same visit.

    A visitor's rows that follow each other within the limit are one session;
    it is given out when the watermark is past its end, and in it every entry
    looks at the row after it, in whatever order they came. As in the batch
    form a visitor is cut into time slots, so no session is longer than a
    slot. Only entries carry their whole row.
    """
    names = df.columns
    spread, own = in_slots(df.withWatermark(time, delay), ts, within_ms, slots)
    entry = F.col("last_page_id").isNull()
    row = F.struct(F.col(ts).alias("at"), F.col(tie).alias("tie"), entry.alias("entry"),
                   F.when(entry & own, F.struct(*[F.col(c).alias(c) for c in names])).alias("row"))
    sessions = spread.groupBy(key, "_slot", F.session_window(time, f"{within_ms} milliseconds")).agg(
        F.sort_array(F.collect_list(row)).alias("_rows"))

    def bounced(x: Column, i: Column) -> Column:
        after = F.get("_rows", i + 1)
        return x.row.isNotNull() & ~F.coalesce((after.at - x.at < within_ms) & ~after.entry, F.lit(False))

    return sessions.select(F.explode(F.filter("_rows", bounced)).alias("_found")).select("_found.row.*")
