"""Behaviour log: visitor flag repair, split by kind, bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopstream.functions.times import time_of_ms

DAY = "1 day"

# Fixed names of the outputs a log is split into.
TOPICS = {
    "page": "dwd_traffic_page_log",
    "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log",
    "action": "dwd_traffic_action_log",
    "error": "dwd_traffic_error_log",
}


def repair_is_new(logs: DataFrame, mid: str = "mid", is_new: str = "is_new", ts: str = "ts") -> DataFrame:
    """Set ``is_new`` to '0' on days after a visitor's first.

    The first row of a visitor fixes its date: that row's day if it says '1',
    else the day before. Later rows that say '1' on another date are wrong.
    Of rows in the same millisecond those that say '1' count as first, so the
    first row is the minimum of one long and needs no sort. Only rows that say
    '1' can change, so only they are shuffled to meet their visitor's first
    date; Spark splits a visitor with very many of them.
    """
    return repair_with(logs, first_seen(logs, mid, is_new, ts), mid, is_new, ts)


def first_seen(logs: DataFrame, mid: str = "mid", is_new: str = "is_new", ts: str = "ts") -> DataFrame:
    """(mid, first_order): each visitor's first row as one long, twice its time and odd if it claims nothing.

    The smaller of two such numbers is that of both sets of rows together.
    """
    claims = F.coalesce(F.col(is_new) == "1", F.lit(False))
    order = F.col(ts) * 2 + F.when(claims, 0).otherwise(1)
    return logs.groupBy(mid).agg(F.min(order).alias("first_order"))


def repair_with(logs: DataFrame, firsts: DataFrame, mid: str = "mid", is_new: str = "is_new", ts: str = "ts") -> DataFrame:
    """:func:`repair_is_new` where the visitors' first rows are known."""
    claims = F.coalesce(F.col(is_new) == "1", F.lit(False))
    known = firsts.select(mid, _first_date(F.col("first_order")).alias("_first_date"))
    wrong = F.to_date(time_of_ms(F.col(ts))) != F.col("_first_date")
    repaired = (
        logs.where(claims).join(known, mid, "left")
        .withColumn(is_new, F.when(wrong, "0").otherwise(F.col(is_new)))
    )
    return logs.where(~claims).unionByName(repaired.select(*logs.columns))


def _first_date(order: Column) -> Column:
    day = F.to_date(time_of_ms(F.floor(order / 2)))
    return F.when(order % 2 == 0, day).otherwise(F.date_sub(day, 1))


def errors(logs: DataFrame) -> DataFrame:
    """Rows with an error; they also go on to start or page."""
    return logs.where("err is not null")


def starts(logs: DataFrame) -> DataFrame:
    return logs.where("start is not null")


def pages(logs: DataFrame) -> DataFrame:
    """Rows that are not a start, without displays and actions."""
    return logs.where("start is null").drop("displays", "actions")


def displays(logs: DataFrame) -> DataFrame:
    """One row per display, with the page's common fields, id and time."""
    return (
        logs.where("start is null")
        .select("common", F.col("page.page_id").alias("page_id"), "ts", F.explode("displays").alias("display"))
    )


def actions(logs: DataFrame) -> DataFrame:
    """One row per action, with the page's common fields and id; it has its own time."""
    return (
        logs.where("start is null")
        .select("common", F.col("page.page_id").alias("page_id"), F.explode("actions").alias("action"))
        .withColumn("ts", F.col("action")["ts"].try_cast("long"))
    )


def route(logs: DataFrame) -> DataFrame:
    """All outputs in one pass as ``topic, value`` rows.

    One scan feeds one sink that routes by ``topic`` (a Kafka topic column or
    a partition column), in place of one scan per output.
    """
    is_page = F.col("start").isNull()
    common, page_id = F.col("common"), F.col("page.page_id")
    whole = F.to_json(F.struct("common", "page", "displays", "actions", "start", "err", "ts"))
    page = F.to_json(F.struct("common", "page", "err", "ts"))

    def one(kind: str, when: Column, value: Column) -> Column:
        row = F.struct(F.lit(TOPICS[kind]).alias("topic"), value.alias("value"))
        return F.when(when, F.array(row)).otherwise(F.array().cast("array<struct<topic:string,value:string>>"))

    def item(kind: str, extra: list[Column]):
        def build(x: Column) -> Column:
            value = F.to_json(F.struct(x.alias(kind), common, page_id.alias("page_id"), *extra))
            return F.struct(F.lit(TOPICS[kind]).alias("topic"), value.alias("value"))
        return build

    def many(kind: str, items: str, extra: list[Column]) -> Column:
        none = F.array().cast("array<map<string,string>>")
        return F.transform(F.when(is_page, F.coalesce(F.col(items), none)).otherwise(none), item(kind, extra))

    rows = F.concat(
        one("error", F.col("err").isNotNull(), whole),
        one("start", ~is_page, whole),
        many("display", "displays", [F.col("ts")]),
        many("action", "actions", []),
        one("page", is_page, page),
    )
    return logs.select(F.inline(rows))


def flatten(logs: DataFrame) -> DataFrame:
    """Nested page log as plain columns plus the row time ``rt``."""
    return logs.select("common.*", "page.*", "ts", time_of_ms(F.col("ts")).alias("rt"))


def bounces(
    pages: DataFrame, tie: str, within_ms: int = 10_000, key: str = "mid", ts: str = "ts", slots: int = 360,
) -> DataFrame:
    """Entry pages not followed within the limit by a page of the same visit.

    An entry (no previous page) is a bounce unless the visitor's next row
    comes less than ``within_ms`` later and is not an entry.

    Only the next ``within_ms`` matter, so a visitor's rows are cut into time
    slots of ``slots`` limits each, and rows in the first limit of a slot are
    also shown to the slot before. The result is exact and a visitor with a
    third of all rows is spread over as many tasks as there are slots.
    """
    spread, own = in_slots(pages, ts, within_ms, slots)
    ordered = Window.partitionBy(key, "_slot").orderBy(ts, tie)
    entry = F.col("last_page_id").isNull()
    gap = F.lead(ts).over(ordered) - F.col(ts)
    visit_goes_on = (gap < within_ms) & ~F.lead(entry).over(ordered)
    return (
        spread.withColumn("_goes_on", F.coalesce(visit_goes_on, F.lit(False)))
        .where(entry & ~F.col("_goes_on") & own)
        .drop("_slot", "_goes_on")
    )


def in_slots(pages: DataFrame, ts: str, within_ms: int, slots: int) -> tuple[DataFrame, Column]:
    """Rows with the time ``_slot`` that must see them, and the test for a row's own slot.

    A slot is ``slots`` limits wide. A row in the first limit of a slot is
    also shown to the slot before, whose last rows it may follow.
    """
    width = within_ms * slots
    slot = F.floor(F.col(ts) / width)
    near_start = F.col(ts) - slot * width < within_ms
    seen_by = F.when(near_start, F.array(slot, slot - 1)).otherwise(F.array(slot))
    return pages.withColumn("_slot", F.explode(seen_by)), F.col("_slot") == slot
