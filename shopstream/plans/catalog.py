"""Named queries over a folder of tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions import keywords, sketches, times
from shopstream.operators import dims, facts, flags, logs, windows
from shopstream.plans import reports, views
from shopstream.plans.warehouse import Stored, Warehouse
from shopstream.session import FREED, remove, settings, shared_dir
from shopstream.sources import sinks, streams
from shopstream.streaming import state
from shopstream.streaming.live import Live

Query = Callable[[SparkSession, str], DataFrame]

# Word list of the dictionary split: a user setting, here syllables of the texts.
DICTIONARY = ["the", "tion", "ent", "ation", "eau", "sh"]

# Routing rules: article rows go to one dimension, customers to another.
RULES = [
    ("part", "dim_sku_info", "id,name,tm_id", "id", None),
    ("customer", "dim_customer", "id,segment", "", None),
]


def config(spark: SparkSession) -> DataFrame:
    """The routing rules as a table; its size is the number of dimensions."""
    return spark.createDataFrame(RULES, "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string")


def config_stream(v: Live) -> DataFrame:
    """The routing rules as captured changes: each is first made with its first column only, then as it is now."""
    path = shared_dir(v.spark, "config-log")
    rules = config(v.spark)
    first = rules.withColumn("sink_columns", F.substring_index("sink_columns", ",", 1))
    for ms, rows in enumerate((first, rules)):
        line = F.to_json(F.struct(F.struct(*rules.columns).alias("after"), F.lit(ms).alias("ts_ms"))).alias("value")
        rows.select(line).coalesce(1).write.mode("append").text(path)
    return streams.config_records(streams.file_lines(v.spark, path, files_per_batch=1))


def _no_clock(df: DataFrame) -> DataFrame:
    return df.drop("row_op_ts", "pt")


def _wide_rows(wide: DataFrame) -> DataFrame:
    return _no_clock(wide).withColumn("old", F.col("old")["order_status"]).withColumnRenamed("old", "old_status")


def _routed(w: Warehouse) -> DataFrame:
    changes = views.part_changes(w.table("part")).unionByName(views.customer_changes(w.table("customer")))
    return dims.route(dims.upserts(changes), config(w.spark))


def dim_route_project(w: Warehouse) -> DataFrame:
    data = F.col("data")
    return _routed(w).select("sink_table", "sink_pk", "type", *(data[c].alias(c) for c in ["id", "name", "tm_id", "segment", "price"]))


def dim_upsert(w: Warehouse) -> DataFrame:
    """Change records into every configured keyed table, in two batches, and the tables read back.

    The second batch repeats the large articles under new names, and knows a
    rule more: only from then on are customers written.
    """
    base = shared_dir(w.spark, "dims")
    rules = config(w.spark)
    changes = views.part_changes(w.table("part")).unionByName(views.customer_changes(w.table("customer")))
    sinks.write_dimensions(changes, rules.where("source_table = 'part'"), base, 0)
    large = changes.where("table = 'customer' or cast(ts as long) > 25")
    data = F.transform_values("data", lambda k, v: F.when((k == "name") & (F.col("table") == "part"), F.upper(v)).otherwise(v))
    sinks.write_dimensions(large.withColumn("data", data), rules, base, 1)
    return dimension_rows(sinks.read_dimensions(w.spark, rules, base))


def dimension_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """All dimensions in one frame; columns a table does not have are null."""
    named = [t.select(F.lit(name).alias("sink_table"), "*") for name, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def pay_upsert(w: Warehouse) -> DataFrame:
    """Paid details as a keyed table: a second batch replays the payments of every other order with another type."""
    path = shared_dir(w.spark, "dwd_trade_pay_detail_suc")
    paid = facts.paid_details(w.trade_changes(), facts.order_details(w.wide()), w.dictionary()).drop("row_op_ts")
    once = shared_dir(w.spark, "paid-details")
    with settings(w.spark, FREED):
        paid.write.parquet(once)  # both batches take their rows from here, so the joins run once
        rows = w.spark.read.schema(paid.schema).parquet(once)
        write = sinks.upsert_batches(path, ["order_detail_id"], ["callback_time", "payment_type_code"])
        write(rows, 0)
        again = rows.where(F.col("order_id").cast("long") % 2 == 0)
        write(again.withColumn("payment_type_code", F.concat(F.lit("again "), "payment_type_code")), 1)
    remove(w.spark, once)
    return sinks.read_upserts(w.spark, path, ["order_detail_id"], ["callback_time", "payment_type_code"]).select(
        "order_detail_id", "order_id", "callback_time", "payment_type_code")


def summary_table(w: Warehouse) -> DataFrame:
    """Traffic rows written to a table partitioned by day and read back without the write time."""
    path = shared_dir(w.spark, "dws_traffic")
    columns = ["vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]
    sinks.write_summary(sinks.summary_rows(w.traffic(), columns), path)
    return w.spark.read.parquet(path).drop("ts")


def province_sketch(w: Warehouse) -> DataFrame:
    """Users per province over all days: exact, and whether the merged sketches of a summary table are within 2 %."""
    rows = views.with_province(w.last_details(), w.table("customer"))
    path = shared_dir(w.spark, "dws_province_users")
    sinks.write_summary(sinks.summary_rows(windows.sketch_window(rows, ["province_id"], "user_id", "30 days"), ["province_id", "user_id_sketch"]), path)
    guessed = w.spark.read.parquet(path).groupBy("province_id").agg(
        sketches.estimate(sketches.merged("user_id_sketch")).alias("guess"))
    exact = rows.groupBy("province_id").agg(F.count_distinct("user_id").alias("user_count"))
    near = F.abs(F.col("guess") - F.col("user_count")) <= 0.02 * F.col("user_count")
    return exact.join(guessed, "province_id").select("province_id", "user_count", near.alias("near"))


def _lines(w: Warehouse) -> DataFrame:
    return views.log_lines(w.table("events"))


def _logs(w: Warehouse) -> DataFrame:
    return streams.logs(_lines(w))


def log_split(w: Warehouse) -> DataFrame:
    return _topic_rows(logs.route(_logs(w)))


def _topic_rows(routed: DataFrame) -> DataFrame:
    """What the JSON of each topic holds: visitor, page, time, and the part the topic is about."""
    def at(path: str) -> Column:
        return F.get_json_object("value", path)

    topic = {kind: F.col("topic") == name for kind, name in logs.TOPICS.items()}
    part = (F.when(topic["display"], at("$.display.item")).when(topic["action"], at("$.action.action_id"))
            .when(topic["start"], at("$.start")).otherwise(at("$.err")))
    page = F.when(topic["page"], at("$.page.page_id")).otherwise(at("$.page_id"))
    return routed.select("topic", at("$.common.mid").alias("mid"), page.alias("page_id"), at("$.ts").cast("long").alias("ts"),
                         part.alias("part"))


def log_dirty(w: Warehouse) -> DataFrame:
    return streams.dirty(_lines(w)).groupBy("value").agg(F.count("*").alias("n"))


def log_displays(w: Warehouse) -> DataFrame:
    rows = logs.displays(_logs(w))
    return rows.select("common.mid", "page_id", "ts", F.col("display")["item"].alias("item"), F.col("display")["pos"].alias("pos"))


def log_actions(w: Warehouse) -> DataFrame:
    rows = logs.actions(_logs(w))
    return rows.select("common.mid", "page_id", "ts", F.col("action")["action_id"].alias("action_id"))


def log_pages(w: Warehouse) -> DataFrame:
    return logs.flatten(logs.pages(_logs(w))).select("mid", "ch", "is_new", "page_id", "last_page_id", "during_time", "ts")


def log_errors_starts(w: Warehouse) -> DataFrame:
    rows = _logs(w)
    return logs.errors(rows).select(F.lit("error").alias("kind"), "common.mid", "ts", F.col("err").alias("body")).unionByName(
        logs.starts(rows).select(F.lit("start").alias("kind"), "common.mid", "ts", F.col("start").alias("body")))


def change_round_trip(w: Warehouse) -> DataFrame:
    """Change records written as JSON text, parsed again and counted by table and type."""
    parsed = streams.changes(sinks.as_json(w.trade_changes()))
    return parsed.groupBy("table", "type").agg(
        F.count("*").alias("n"), F.count(F.col("old")["order_status"]).alias("turned"),
        F.sum(F.col("data")["order_id"].cast("long")).alias("order_sum"))


def keyword_dictionary(w: Warehouse) -> DataFrame:
    found = F.explode(keywords.dictionary_words(F.col("item"), DICTIONARY)).alias("word")
    return w.searches().select(found).groupBy("word").agg(F.count("*").alias("n"))


def keyword_udtf(w: Warehouse) -> DataFrame:
    keywords.register(w.spark)
    return w.spark.sql("select word, count(*) as n from {searches}, lateral split_words(item) group by word", searches=w.searches())


def time_functions(w: Warehouse) -> DataFrame:
    at = views.time_text("o_orderdate")
    ms = F.unix_millis("o_orderdate")
    later = F.concat(F.substring(at, 1, 10), F.lit("T00:00:00."), F.when(F.col("o_orderstatus") == "F", "04").otherwise("040"), F.lit("Z"))
    late = F.concat(F.substring(at, 1, 10), F.lit("T00:00:00."), F.when(F.col("o_orderstatus") == "O", "039").otherwise("040"), F.lit("Z"))
    return w.table("orders").select(
        "o_orderkey", times.to_ts(at).alias("ms"), times.to_date_text(ms).alias("day"), times.to_time_text(ms).alias("at"),
        times.date_part(at).alias("part"), times.day_number(F.col("o_orderdate")).alias("day_no"),
        times.compare_times(late, later).alias("order_no"), times.on_day(F.col("o_orderdate"), "1998-10-03").alias("that_day"))


def returning_user(w: Warehouse) -> DataFrame:
    firsts = windows.login_firsts(windows.login_rows(w.pages()), 2)
    return firsts.select("uid", "dt", "is_back")


def _page_daily(w: Warehouse) -> DataFrame:
    return windows.page_firsts(w.pages()).select("mid", "page_id", "dt", F.unix_millis("rt").alias("ts"))


def _new_user(w: Warehouse) -> DataFrame:
    firsts = flags.with_first_ever(flags.daily_first(w.pages(), ["uid"], "rt"), "uid")
    return firsts.select("uid", "dt", F.unix_millis("rt").alias("ts"), "is_first_ever")


def _orders_flagged(w: Warehouse) -> DataFrame:
    rows = w.pages().select("mid", "rt", "event_id")
    return flags.flag_rows(rows, "mid", "rt", "event_id").select("event_id", "is_daily_first", "is_first_ever")


def _enriched(w: Warehouse) -> DataFrame:
    rows = w.table("lineitem").select("l_orderkey", "l_linenumber", views.text("l_partkey").alias("sku_id"), "l_suppkey", "l_shipdate")
    rows = dims.enrich(rows, w.sku(), "sku_id", {"spu_id": "spu_id", "trademark_id": "tm_id", "category3_id": "category3_id"})
    return dims.with_categories(rows, w.categories()).groupBy(
        "trademark_id", "category1_name", "category2_name", "category3_name").agg(F.count("*").alias("n"))


OPERATORS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # One row per key, flags
    "dedup_first": lambda w: views.first_lines(w.table("lineitem")),
    "dedup_last": lambda w: views.last_lines(w.table("lineitem")),
    "unique_visitor": lambda w: w.visitors().select("event_id", "mid", "ch", "ts"),
    "daily_unique_user": lambda w: flags.daily_first(w.pages(), ["mid"], "rt").select("mid", "dt", F.unix_millis("rt").alias("ts")),
    "new_user_flag": _new_user,
    "order_flags": _orders_flagged,
    "page_daily_unique": _page_daily,
    "returning_user": returning_user,
    # Behaviour log
    "is_new_repair": lambda w: logs.repair_is_new(w.pages()).select("event_id", "mid", "ts", "is_new"),
    "bounce": lambda w: w.bounces().select("event_id", "mid", "ch", "ts"),
    "log_split": log_split,
    "log_dirty": log_dirty,
    "explode_displays": log_displays,
    "explode_actions": log_actions,
    "log_pages": log_pages,
    "log_errors_starts": log_errors_starts,
    # Business facts
    "change_round_trip": change_round_trip,
    "comment_add": lambda w: facts.comments(w.shop_changes(), w.dictionary()),
    "favor_add": lambda w: facts.favorites(w.shop_changes()),
    "coupon_get": lambda w: facts.coupons_got(w.shop_changes()),
    "coupon_order": lambda w: facts.coupons_ordered(w.shop_changes()),
    "coupon_pay": lambda w: facts.coupons_paid(w.shop_changes()),
    "cart_delta": lambda w: w.cart_adds(),
    "user_register": lambda w: facts.registrations(w.shop_changes()),
    "order_wide": lambda w: _wide_rows(w.wide()),
    "order_detail": lambda w: _no_clock(facts.order_details(w.wide())),
    "order_cancel": lambda w: facts.cancelled_details(w.wide()),
    "pay_detail": lambda w: facts.paid_details(w.trade_changes(), facts.order_details(w.wide()), w.dictionary()).drop("row_op_ts"),
    "pay_upsert": pay_upsert,
    "order_refund": lambda w: facts.refunds(w.trade_changes(), w.dictionary()).drop("row_op_ts"),
    "refund_pay": lambda w: facts.refunds_paid(w.trade_changes(), w.dictionary()).drop("row_op_ts"),
    # Dimensions
    "dim_route_project": dim_route_project,
    "dim_upsert": dim_upsert,
    "dim_enrich": _enriched,
    "category_chain": lambda w: w.categories(),
    # Summary tables
    "traffic_window": lambda w: w.traffic(),
    "page_view_window": lambda w: w.page_views(),
    "keyword_window": lambda w: w.keywords(),
    "keyword_dictionary": keyword_dictionary,
    "keyword_udtf": keyword_udtf,
    "login_window": lambda w: w.logins(),
    "register_window": lambda w: w.registers(),
    "cart_window": lambda w: w.carts(),
    "order_window": lambda w: w.orders(),
    "payment_window": lambda w: w.payments(),
    "province_window": lambda w: w.provinces(),
    "user_item_window": lambda w: w.user_spu(),
    "refund_window": lambda w: w.refunds(),
    "sum_window": lambda w: windows.sum_window(w.pages(), ["mid"], "during_time", "1 hour"),
    "summary_table": summary_table,
    "province_sketch": province_sketch,
    "time_functions": time_functions,
}

# Each takes the summary tables and a day, or None for all days
REPORTS: dict[str, Callable[[Warehouse, reports.Day], DataFrame]] = {
    "report_activity": lambda w, day: reports.activity_stats(w.orders(), day),
    "report_coupon": lambda w, day: reports.coupon_stats(w.orders(), day),
    "report_trademark": lambda w, day: reports.trademark_stats(w.user_spu(), w.refunds(), day),
    "report_trademark_amount": lambda w, day: reports.trademark_amounts(w.user_spu(), day),
    "report_category": lambda w, day: reports.category_stats(w.user_spu(), w.refunds(), day),
    "report_spu": lambda w, day: reports.spu_stats(w.user_spu(), day),
    "report_top_trademark": lambda w, day: reports.top_trademarks(w.user_spu(), day),
    "report_total_amount": lambda w, day: reports.total_amount(w.provinces(), day),
    "report_trade": lambda w, day: reports.trade_stats(w.user_spu(), w.refunds(), day),
    "report_province_orders": lambda w, day: reports.province_orders(w.provinces(), day),
    "report_province_amount": lambda w, day: reports.province_amounts(w.provinces(), day),
    "report_channel_uv": lambda w, day: reports.channel_visitors(w.traffic(), day),
    "report_channel_sessions": lambda w, day: reports.channel_sessions(w.traffic(), day),
    "report_channel_pages": lambda w, day: reports.channel_pages_per_session(w.traffic(), day),
    "report_channel_time": lambda w, day: reports.channel_time_per_session(w.traffic(), day),
    "report_channel_bounce": lambda w, day: reports.channel_bounce_rate(w.traffic(), day),
    "report_channel_uv_uj": lambda w, day: reports.channel_visitors_and_bounces(w.traffic(), day),
    "report_keyword": lambda w, day: reports.keyword_scores(w.keywords(), day),
    "report_visitor_type": lambda w, day: reports.visitor_types(w.traffic(), day),
    "report_visitor_table": lambda w, day: reports.visitor_type_table(w.traffic(), day),
    "report_hourly": lambda w, day: reports.hourly_visitors(w.traffic(), day),
    "report_hourly_filled": lambda w, day: reports.hourly_visitors_filled(w.traffic(), day),
    "report_funnel": lambda w, day: reports.funnel(w.page_views(), w.carts(), w.orders(), w.payments(), day),
    "report_user_change": lambda w, day: reports.user_changes(w.logins(), w.registers(), day),
    "report_new_trade_users": lambda w, day: reports.new_trade_users(w.orders(), w.payments(), day),
}

# The one day of a report: one that the tables hold, by what it reads.
EVENT_DAY, ORDER_DAY, SEARCH_DAY = "2024-01-15", "1995-06-17", "1970-01-01"
REPORT_DAYS = {name: ORDER_DAY for name in REPORTS} | {"report_keyword": SEARCH_DAY, "report_user_change": EVENT_DAY} | {
    name: EVENT_DAY for name in REPORTS if name.startswith(("report_channel", "report_visitor", "report_hourly"))}

OPERATORS |= {name: lambda w, build=build: build(w, None) for name, build in REPORTS.items()}
OPERATORS |= {f"{name}_day": lambda w, build=build, day=REPORT_DAYS[name]: build(Stored(w.spark, w.sf_dir), day)
              for name, build in REPORTS.items()}


STREAMS: dict[str, Callable[[Live], DataFrame]] = {
    "stream_is_new_repair": lambda v: v.repaired().select("event_id", "mid", "ts", "is_new"),
    "stream_unique_visitor": lambda v: v.visitors().select("event_id", "mid", "ch", "ts"),
    "stream_bounce": lambda v: v.bounces().select("event_id", "mid", "ch", "ts"),
    "stream_log_split": lambda v: _topic_rows(v.topics()),
    "stream_dim_upsert": lambda v: dimension_rows(v.dimensions(v.rules(config_stream(v)))),
    "stream_dim_enrich": lambda v: v.named_lines(v.rules(config_stream(v))).groupBy("trademark_id", "sku_name").agg(F.count("*").alias("n")),
    "stream_traffic_window": lambda v: v.traffic().drop("dt"),
    "stream_report_channel_uv_day": lambda v: reports.channel_visitors(v.traffic(), EVENT_DAY),
    "stream_page_view_window": lambda v: v.page_views(),
    "stream_keyword_window": lambda v: v.keywords(),
    "stream_login_window": lambda v: v.logins(),
    "stream_register_window": lambda v: v.registers(),
    "stream_cart_window": lambda v: v.carts(),
    "stream_province_window": lambda v: v.provinces(),
    "stream_refund_window": lambda v: v.refunds(),
    "stream_payment_window": lambda v: v.payments(),
    "stream_interval_join": lambda v: v.order_wide(),
    "stream_dedup_first": lambda v: v.land_firsts(
        state.first_rows(v.stream("lineitem"), views.LINE_KEY, ["l_shipdate", *views.LINE_REST], every=None), "first_lines"),
    "stream_order_wide": lambda v: _wide_rows(v.wide()),
    "stream_pay_detail": lambda v: v.paid().drop("row_op_ts"),
    "stream_order_refund": lambda v: v.refund_requests().drop("row_op_ts"),
    "stream_refund_pay": lambda v: v.refund_payments().drop("row_op_ts"),
    "stream_order_window": lambda v: v.orders(),
    "stream_user_item_window": lambda v: v.user_spu(),
    "stream_province_detail_window": lambda v: v.detail_provinces(),
}


def queries() -> dict[str, Query]:
    def table(build: Callable[[Warehouse], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(Warehouse(spark, sf_dir))

    def stream(build: Callable[[Live], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(Live(spark, sf_dir))

    named = {name: table(build) for name, build in OPERATORS.items()}
    return named | {name: stream(build) for name, build in STREAMS.items()}
