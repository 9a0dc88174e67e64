"""Daily reports over the windowed aggregates.

Every report takes ``day``: a date for one day, :data:`TODAY`, or None for all
days at once. Rows carry the day as ``dt``. A stored summary table is
partitioned by ``dt``, and a report of one day reads that partition only. Over
windows that are worked out on the fly the day is a range on the window start,
after the aggregate.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopstream.functions.money import minor, ratio, total

TODAY = "today"
Day = date | str | None

# Fixed weights of keyword sources.
KEYWORD_WEIGHTS = {"SEARCH": 10, "ORDER": 5, "CART": 2, "CLICK": 1}

# Fixed row labels: orders, ordering users, refunds, refunding users.
TRADE_LABELS = ["下单数", "下单人数", "退单数", "退单人数"]

# Fixed row labels: visitors, page views, bounce rate, session seconds, session pages.
VISITOR_LABELS = ["访客数(人)", "总访问页面数(次)", "跳出率(%)", "平均在线时长(秒)", "平均访问页面数(人次)"]


def _daily(dws: DataFrame, day: Day) -> DataFrame:
    if "dt" not in dws.columns:
        if day is not None:
            start = F.current_date() if day == TODAY else F.lit(str(day)).cast("date")
            dws = dws.where((F.col("stt") >= start.cast("string")) & (F.col("stt") < F.date_add(start, 1).cast("string")))
        return dws.withColumn("dt", F.col("stt").cast("date"))
    if day is not None:
        dws = dws.where(F.col("dt") == (F.current_date() if day == TODAY else F.lit(str(day)).cast("date")))
    return dws


def _sum(name: str, alias: str | None = None) -> Column:
    return F.sum(name).alias(alias or name)


def _amount(name: str) -> Column:
    """Sum of window amounts, exact to a millionth."""
    return total(minor(F.col(name))).alias(name)


def _subsidy(orders: DataFrame, day: Day, reduce: str, alias: str, rate: str) -> DataFrame:
    sums = _daily(orders, day).groupBy("dt").agg(_amount(reduce), _amount("order_origin_total_amount"))
    share = F.round(ratio(F.round(reduce, 5), F.round("order_origin_total_amount", 5)), 20)
    return sums.select(
        "dt", F.col(reduce).alias(alias), F.col("order_origin_total_amount").alias("origin_total_amount"), share.alias(rate))


def activity_stats(orders: DataFrame, day: Day = None) -> DataFrame:
    """Activity reduction, original total and subsidy rate."""
    return _subsidy(orders, day, "order_activity_reduce_amount", "activity_reduce_amount", "subsidy_rate")


def coupon_stats(orders: DataFrame, day: Day = None) -> DataFrame:
    """Coupon reduction, original total and subsidy rate."""
    return _subsidy(orders, day, "order_coupon_reduce_amount", "coupon_reduce_amount", "coupon_subsidy_rate")


def _goods(orders: DataFrame, refunds: DataFrame, day: Day, ids: list[str], names: list[str]) -> DataFrame:
    """Order and refund measures side by side; a side without rows counts as 0."""
    keys = ["dt", *ids]
    bought = _daily(orders, day).groupBy(*keys, *names).agg(
        _sum("order_count"), F.count_distinct("user_id").alias("uu_count"), _amount("order_amount"))
    returned = _daily(refunds, day).groupBy(*keys, *names).agg(
        _sum("refund_count"), F.count_distinct("user_id").alias("refund_uu_count"))
    o, r = bought.alias("o"), returned.alias("r")
    on = F.lit(True)
    for c in keys:
        on &= F.col(f"o.{c}") == F.col(f"r.{c}")
    both = [F.coalesce(f"o.{c}", f"r.{c}").alias(c) for c in ["dt", *names]]
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ["order_count", "uu_count", "order_amount", "refund_count", "refund_uu_count"]]
    return o.join(r, on, "full").select(*both, *zero)


def trademark_stats(orders: DataFrame, refunds: DataFrame, day: Day = None) -> DataFrame:
    return _goods(orders, refunds, day, ["trademark_id"], ["trademark_name"])


def category_stats(orders: DataFrame, refunds: DataFrame, day: Day = None) -> DataFrame:
    levels = ["category1", "category2", "category3"]
    return _goods(orders, refunds, day, [f"{c}_id" for c in levels], [f"{c}_name" for c in levels])


def trademark_amounts(orders: DataFrame, day: Day = None) -> DataFrame:
    """Amount per trademark (pie chart)."""
    return _daily(orders, day).groupBy("dt", "trademark_id", "trademark_name").agg(_amount("order_amount")).drop("trademark_id")


def spu_stats(orders: DataFrame, day: Day = None) -> DataFrame:
    return _daily(orders, day).groupBy("dt", "spu_id", "spu_name").agg(
        _sum("order_count"), F.count_distinct("user_id").alias("uu_count"), _amount("order_amount")).drop("spu_id")


def top_trademarks(orders: DataFrame, day: Day = None, limit: int = 5) -> DataFrame:
    """The ``limit`` trademarks with the highest amount of a day; ties by name."""
    amounts = _daily(orders, day).groupBy("dt", "trademark_name").agg(_amount("order_amount"))
    best = Window.partitionBy("dt").orderBy(F.desc("order_amount"), "trademark_name")
    return amounts.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= limit).drop("_rank")


def total_amount(provinces: DataFrame, day: Day = None) -> DataFrame:
    """Order amount of the day."""
    return _daily(provinces, day).groupBy("dt").agg(_amount("order_amount")).withColumnRenamed("order_amount", "order_total_amount")


def _unpivot(df: DataFrame, label: str, value: str, rows: dict[str, str]) -> DataFrame:
    """Columns to rows: ``rows`` maps a label to the column that holds its value."""
    items = F.array(*(F.struct(F.lit(k).alias(label), F.col(v).alias(value)) for k, v in rows.items()))
    return df.select("dt", F.inline(items))


def trade_stats(orders: DataFrame, refunds: DataFrame, day: Day = None) -> DataFrame:
    """Orders, ordering users, refunds and refunding users as four rows."""
    bought = _daily(orders, day).groupBy("dt").agg(_sum("order_count", "n"), F.count_distinct("user_id").alias("users"))
    returned = _daily(refunds, day).groupBy("dt").agg(_sum("refund_count", "n"), F.count_distinct("user_id").alias("users"))
    return _unpivot(bought, "type", "value", dict(zip(TRADE_LABELS[:2], ["n", "users"]))).unionByName(
        _unpivot(returned, "type", "value", dict(zip(TRADE_LABELS[2:], ["n", "users"]))))


def province_orders(provinces: DataFrame, day: Day = None) -> DataFrame:
    return _daily(provinces, day).groupBy("dt", "province_id", "province_name").agg(_sum("order_count")).drop("province_id")


def province_amounts(provinces: DataFrame, day: Day = None) -> DataFrame:
    """Amount per province that has a name."""
    named = _daily(provinces, day).where("province_name is not null and province_name <> ''")
    return named.groupBy("dt", "province_id", "province_name").agg(_amount("order_amount")).drop("province_id")


def _channel(traffic: DataFrame, day: Day, value: Column, name: str) -> DataFrame:
    rows = _daily(traffic, day).groupBy("dt", "ch").agg(value.alias(name))
    return rows.orderBy("dt", F.desc(name), "ch")


def channel_visitors(traffic: DataFrame, day: Day = None) -> DataFrame:
    return _channel(traffic, day, F.sum("uv_ct"), "uv_ct")


def channel_sessions(traffic: DataFrame, day: Day = None) -> DataFrame:
    return _channel(traffic, day, F.sum("sv_ct"), "sv_ct")


def channel_pages_per_session(traffic: DataFrame, day: Day = None) -> DataFrame:
    return _channel(traffic, day, ratio(F.sum("pv_ct"), F.sum("sv_ct")), "pv_per_session")


def channel_time_per_session(traffic: DataFrame, day: Day = None) -> DataFrame:
    return _channel(traffic, day, ratio(F.sum("dur_sum"), F.sum("sv_ct")), "dur_per_session")


def channel_bounce_rate(traffic: DataFrame, day: Day = None) -> DataFrame:
    return _channel(traffic, day, ratio(F.sum("uj_ct"), F.sum("sv_ct")), "uj_rate")


def channel_visitors_and_bounces(traffic: DataFrame, day: Day = None) -> DataFrame:
    """Visitors and bounces per channel, unsorted."""
    return _daily(traffic, day).groupBy("dt", "ch").agg(_sum("uv_ct"), _sum("uj_ct"))


def keyword_scores(keywords: DataFrame, day: Day = None) -> DataFrame:
    """Counts weighted by source, best first."""
    weight = F.lit(0)
    for source, points in KEYWORD_WEIGHTS.items():
        weight = F.when(F.upper("source") == source, points).otherwise(weight)
    scores = _daily(keywords, day).groupBy("dt", "keyword").agg(F.sum(F.col("keyword_count") * weight).alias("keyword_score"))
    return scores.orderBy("dt", F.desc("keyword_score"), "keyword")


def visitor_types(traffic: DataFrame, day: Day = None) -> DataFrame:
    """Totals per visitor type with bounce rate, seconds and pages per session (0 without sessions)."""
    sums = _daily(traffic, day).groupBy("dt", "is_new").agg(*(_sum(c) for c in ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]))

    def per_session(name: str) -> Column:
        return F.coalesce(ratio(F.col(name), F.col("sv_ct")), F.lit(0.0))

    return sums.withColumns({
        "uj_rate": per_session("uj_ct"), "avg_dur_sum": per_session("dur_sum") / 1000, "avg_pv_ct": per_session("pv_ct"),
    })


def visitor_type_table(traffic: DataFrame, day: Day = None) -> DataFrame:
    """The figures of :func:`visitor_types` as metric rows with a column per type."""
    names = ["uv_ct", "pv_ct", "uj_rate", "avg_dur_sum", "avg_pv_ct"]
    types = visitor_types(traffic, day).select("dt", "is_new", *(F.col(c).cast("double") for c in names))
    items = F.array(*(F.struct(F.lit(k).alias("type"), F.col(c).alias("value")) for k, c in zip(VISITOR_LABELS, names)))
    rows = types.select("dt", "is_new", F.inline(items))
    new = F.col("is_new") == "1"
    return rows.groupBy("dt", "type").agg(
        F.max(F.when(new, F.col("value"))).alias("new"), F.max(F.when(~new, F.col("value"))).alias("old"))


def hourly_visitors(traffic: DataFrame, day: Day = None) -> DataFrame:
    new = F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)
    return _daily(traffic, day).groupBy("dt", F.hour(F.col("stt").cast("timestamp")).alias("hr")).agg(
        _sum("uv_ct"), _sum("pv_ct"), F.sum(new).alias("new_uv_ct"))


def hourly_visitors_filled(traffic: DataFrame, day: Day = None) -> DataFrame:
    """:func:`hourly_visitors` with zeros for hours without rows.

    A day has at most 24 rows by now, so they are gathered into one map.
    """
    names = ["uv_ct", "pv_ct", "new_uv_ct"]
    hours = F.map_from_entries(F.collect_list(F.struct("hr", F.struct(*names))))
    days = hourly_visitors(traffic, day).groupBy("dt").agg(hours.alias("hours"))
    filled = days.select("dt", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hr"), "hours")
    found = F.try_element_at("hours", F.col("hr"))
    return filled.select("dt", "hr", *(F.coalesce(found[n], F.lit(0).cast("long")).alias(n) for n in names))


def _labelled(dws: DataFrame, day: Day, label: str, value: str, rows: dict[str, str]) -> DataFrame:
    sums = _daily(dws, day).groupBy("dt").agg(*(_sum(c) for c in rows.values()))
    return _unpivot(sums, label, value, rows)


def funnel(pages: DataFrame, carts: DataFrame, orders: DataFrame, payments: DataFrame, day: Day = None) -> DataFrame:
    """Unique users per step: home, detail, cart, trade, payment."""
    def step(dws: DataFrame, rows: dict[str, str]) -> DataFrame:
        return _labelled(dws, day, "page_id", "uv_ct", rows)

    return (
        step(pages, {"home": "home_uv_ct", "good_detail": "good_detail_uv_ct"})
        .unionByName(step(carts, {"cart": "cart_add_uu_ct"}))
        .unionByName(step(orders, {"trade": "order_unique_user_count"}))
        .unionByName(step(payments, {"payment": "payment_suc_unique_user_count"}))
    )


def user_changes(logins: DataFrame, registers: DataFrame, day: Day = None) -> DataFrame:
    """Returning, active and new users."""
    return _labelled(logins, day, "type", "user_ct", {"backCt": "back_ct", "activeUserCt": "uu_ct"}).unionByName(
        _labelled(registers, day, "type", "user_ct", {"newUserCt": "register_ct"}))


def new_trade_users(orders: DataFrame, payments: DataFrame, day: Day = None) -> DataFrame:
    """First-time ordering and paying users."""
    return _labelled(orders, day, "trade_type", "user_ct", {"order": "order_new_user_count"}).unionByName(
        _labelled(payments, day, "trade_type", "user_ct", {"payment": "payment_suc_new_user_count"}))
