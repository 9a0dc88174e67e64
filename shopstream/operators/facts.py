"""Business facts from change records.

Change records hold their row as a string map. Every fact filters on the
plain columns (database, table, type) before it touches the map, projects the
keys it needs, and joins only then.

``within`` bounds the joins of streams: an interval such as "15 minutes" that
the event times of two joined rows may differ by. Without it the joins are
plain, which is the form for tables. The watermark is set on each cut of the
topic; start such jobs under ``streams.one_topic``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.times import date_text

# Fixed status codes of the source system.
ORDER_CANCELLED = "1003"
ORDER_REFUNDING = "1005"
ORDER_REFUNDED = "1006"
COUPON_GOT = "1401"
COUPON_USED_IN_ORDER = "1402"
PAYMENT_DONE = "1602"

# Fixed columns of the source tables and of the facts.
ORDER_DETAIL = [
    "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "source_type", "source_id",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
]
ORDER_INFO = [
    "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id", "payment_way", "delivery_address",
    "order_comment", "out_trade_no", "trade_body", "operate_time", "expire_time", "process_status", "tracking_no",
    "parent_order_id", "province_id", "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "feight_fee_reduce", "refundable_time",
]
CART_INFO = [
    "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked", "create_time", "operate_time",
    "is_ordered", "order_time", "source_type", "source_id",
]
DETAIL_FACT = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "sku_num", "order_price", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "create_time", "source_id", "source_type_id", "source_type_name",
    "split_activity_amount", "split_coupon_amount", "split_total_amount",
]


# A topic, or a topic cut by source table.
Changes = DataFrame | Mapping[str, DataFrame]


def rows_of(changes: Changes, table: str, types: Sequence[str] = (), database: str | None = None) -> DataFrame:
    """Change records of one table, by type and database if given."""
    rows = (changes if isinstance(changes, DataFrame) else changes[table]).where(F.col("table") == table)
    if types:
        rows = rows.where(F.col("type").isin(list(types)))
    return rows if database is None else rows.where(F.col("database") == database)


def fields(*names: str) -> list[Column]:
    return [F.col("data")[n].alias(n) for n in names]


def event_time(changes: Changes) -> Changes:
    """Add ``pt`` from the record's ``ts`` (epoch seconds)."""
    if not isinstance(changes, DataFrame):
        return {name: event_time(rows) for name, rows in changes.items()}
    return changes.withColumn("pt", F.timestamp_seconds(F.col("ts").try_cast("long")))


def marked(rows: DataFrame, time: str = "pt", delay: str = "2 seconds") -> DataFrame:
    """Rows cut from a topic with a watermark, if a stream.

    Projections don't move below a watermark, so it comes after them: else
    every record of the topic is made whole, maps and all, for each cut of it.
    """
    return rows.withWatermark(time, delay) if rows.isStreaming else rows


def code_names(dictionary: DataFrame, code: str, name: str) -> DataFrame:
    return dictionary.select(F.col("dic_code").alias(code), F.col("dic_name").alias(name))


def join_within(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, within: str | None, right_time: str,
) -> DataFrame:
    """Equi-join; with ``within`` also |left.pt - right.<right_time>| <= within.

    On streams both times must carry a watermark.
    """
    if within is None:
        return left.join(right.drop(right_time), list(on), how)
    kept = [c for c in right.columns if c not in {*on, right_time}]
    l, r = left.alias("l"), right.alias("r")
    span = F.expr(f"interval {within}")
    lt, rt = F.col("l.pt"), F.col(f"r.{right_time}")
    condition = (rt >= lt - span) & (rt <= lt + span)
    for c in on:
        condition &= F.col(f"l.{c}") == F.col(f"r.{c}")
    return l.join(r, condition, how).select("l.*", *(F.col(f"r.{c}") for c in kept))


def comments(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Comments written, with the name of the rating."""
    rows = rows_of(changes, "comment_info", ["insert"], database).select(
        *fields("id", "user_id", "sku_id", "order_id", "create_time"), F.col("data")["appraise"].alias("appraise_code"), "ts")
    return rows.join(code_names(dictionary, "appraise_code", "appraise_name"), "appraise_code").select(
        "id", "user_id", "sku_id", "order_id", date_text(F.col("create_time")).alias("date_id"), "create_time",
        "appraise_code", "appraise_name", "ts")


def favorites(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Favourites added, also again after a cancel."""
    rows = rows_of(changes, "favor_info", ["insert", "update"], database)
    added = (F.col("type") == "insert") | (F.col("data")["is_cancel"] == "0")
    return rows.where(added).select(
        *fields("id", "user_id", "sku_id"), date_text(F.col("data")["create_time"]).alias("date_id"),
        *fields("create_time"), "ts")


def _coupon(rows: DataFrame, time: str, name: str, order: bool = True) -> DataFrame:
    keys = ["id", "coupon_id", "user_id"] + (["order_id"] if order else [])
    return rows.select(
        *fields(*keys), date_text(F.col("data")[time]).alias("date_id"), F.col("data")[time].alias(name), "ts")


def coupons_got(changes: DataFrame, database: str | None = None) -> DataFrame:
    return _coupon(rows_of(changes, "coupon_use", ["insert"], database), "get_time", "get_time", order=False)


def coupons_ordered(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Coupons put on an order: the status went from got to used in order."""
    rows = rows_of(changes, "coupon_use", ["update"], database).where(
        (F.col("data")["coupon_status"] == COUPON_USED_IN_ORDER) & (F.col("old")["coupon_status"] == COUPON_GOT))
    return _coupon(rows, "using_time", "order_time")


def coupons_paid(changes: DataFrame, database: str | None = None) -> DataFrame:
    rows = rows_of(changes, "coupon_use", ["update"], database).where(F.col("data")["used_time"].isNotNull())
    return _coupon(rows, "used_time", "payment_time")


def cart_adds(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Goods put in a cart: new rows, and updates that raise the quantity, by the difference."""
    rows = rows_of(changes, "cart_info", ["insert", "update"], database)
    now = F.col("data")["sku_num"].try_cast("int")
    before = F.col("old")["sku_num"].try_cast("int")
    inserted = F.col("type") == "insert"
    added = F.when(inserted, F.col("data")["sku_num"]).otherwise((now - before).cast("string"))
    rows = rows.where(inserted | (now > before)).select(
        *(added.alias(c) if c == "sku_num" else F.col("data")[c].alias(c) for c in CART_INFO))
    rows = rows.withColumnRenamed("source_type", "source_type_id")
    return rows.join(code_names(dictionary, "source_type_id", "source_type_name"), "source_type_id").select(
        *CART_INFO[:-2], "source_type_id", "source_type_name", "source_id")


def order_wide(
    changes: Changes, dictionary: DataFrame, database: str | None = None, within: str | None = None,
) -> DataFrame:
    """Order details with order, activity, coupon and source name.

    Rows whose source is not in the dictionary go first, then the two joins on
    the detail id share one partitioning, then the order joins on its id.
    """
    timed = event_time(changes)
    details = (
        marked(rows_of(timed, "order_detail", ["insert"], database).select(*fields(*ORDER_DETAIL), "pt"))
        .withColumnRenamed("source_type", "source_type_id")
        .join(code_names(dictionary, "source_type_id", "source_type_name"), "source_type_id")
    )
    activities = marked(rows_of(timed, "order_detail_activity", ["insert"], database).select(
        F.col("data")["order_detail_id"].alias("id"), F.col("data")["id"].alias("order_detail_activity_id"),
        *fields("activity_id", "activity_rule_id"), F.col("pt").alias("activity_pt")), "activity_pt")
    coupons = marked(rows_of(timed, "order_detail_coupon", ["insert"], database).select(
        F.col("data")["order_detail_id"].alias("id"), F.col("data")["id"].alias("order_detail_coupon_id"),
        *fields("coupon_id", "coupon_use_id"), F.col("pt").alias("coupon_pt")), "coupon_pt")
    orders = marked(rows_of(timed, "order_info", ["insert", "update"], database).select(
        F.col("data")["id"].alias("order_id"), *fields(*ORDER_INFO[1:]), "type", "old", F.col("pt").alias("order_pt")), "order_pt")

    wide = join_within(details, activities, ["id"], "left", within, "activity_pt")
    wide = join_within(wide, coupons, ["id"], "left", within, "coupon_pt")
    wide = join_within(wide, orders, ["order_id"], "inner", within, "order_pt")
    return wide.select(
        *ORDER_DETAIL[:7], "source_type_id", "source_type_name", *ORDER_DETAIL[8:], *ORDER_INFO[1:],
        "order_detail_activity_id", "activity_id", "activity_rule_id",
        "order_detail_coupon_id", "coupon_id", "coupon_use_id", "type", "old", "pt",
        F.current_timestamp().alias("row_op_ts"))


def order_details(wide: DataFrame) -> DataFrame:
    """Ordered details: wide rows of new orders."""
    return wide.where("type = 'insert'").select(*DETAIL_FACT, "row_op_ts", "pt")


def cancelled_details(wide: DataFrame) -> DataFrame:
    """Details of orders whose status changed to cancelled."""
    changed = (F.col("type") == "update") & F.col("old")["order_status"].isNotNull()
    rows = wide.where(changed & (F.col("order_status") == ORDER_CANCELLED))
    rest = ["source_id", "source_type_id", "source_type_name", "sku_num", "order_price", *DETAIL_FACT[-3:]]
    return rows.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", F.col("operate_time").alias("cancel_time"), *rest)


def paid_details(
    changes: Changes, details: DataFrame, dictionary: DataFrame, database: str | None = None, within: str | None = None,
) -> DataFrame:
    """Details of paid orders, one per detail and payment; upsert by ``order_detail_id``."""
    done = rows_of(event_time(changes), "payment_info", ["update"], database).where(F.col("data")["payment_status"] == PAYMENT_DONE)
    paid = (
        marked(done.select(*fields("order_id", "callback_time"), F.col("data")["payment_type"].alias("payment_type_code"), "pt"))
        .join(code_names(dictionary, "payment_type_code", "payment_type_name"), "payment_type_code")
    )
    right = details.withColumnRenamed("pt", "detail_pt")
    rows = join_within(paid, right, ["order_id"], "inner", within, "detail_pt")
    return rows.select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name", "province_id",
        "activity_id", "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name", "callback_time",
        "source_id", "source_type_id", "source_type_name", "sku_num", "order_price", "split_activity_amount",
        "split_coupon_amount", F.col("split_total_amount").alias("split_payment_amount"), "row_op_ts")


def _orders_turned(changes: Changes, status: str, database: str | None, *names: str) -> DataFrame:
    """Orders whose status changed to the given one."""
    rows = rows_of(changes, "order_info", ["update"], database)
    rows = rows.where((F.col("data")["order_status"] == status) & F.col("old")["order_status"].isNotNull())
    return marked(rows.select(F.col("data")["id"].alias("order_id"), *fields(*names), F.col("pt").alias("order_pt")), "order_pt")


def refunds(
    changes: Changes, dictionary: DataFrame, database: str | None = None, within: str | None = None,
) -> DataFrame:
    """Refund requests of orders that turned to refunding, with type and reason names."""
    timed = event_time(changes)
    rows = marked(rows_of(timed, "order_refund_info", ["insert"], database).select(
        *fields("id", "user_id", "order_id", "sku_id", "create_time", "refund_reason_txt", "refund_num", "refund_amount"),
        F.col("data")["refund_type"].alias("refund_type_code"),
        F.col("data")["refund_reason_type"].alias("refund_reason_type_code"), "ts", "pt"))
    rows = rows.join(code_names(dictionary, "refund_type_code", "refund_type_name"), "refund_type_code")
    rows = rows.join(code_names(dictionary, "refund_reason_type_code", "refund_reason_type_name"), "refund_reason_type_code")
    rows = join_within(rows, _orders_turned(timed, ORDER_REFUNDING, database, "province_id"), ["order_id"], "inner", within, "order_pt")
    return rows.select(
        "id", "user_id", "order_id", "sku_id", "province_id", date_text(F.col("create_time")).alias("date_id"),
        "create_time", "refund_type_code", "refund_type_name", "refund_reason_type_code", "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts", F.current_timestamp().alias("row_op_ts"))


def refunds_paid(
    changes: Changes, dictionary: DataFrame, database: str | None = None, within: str | None = None,
) -> DataFrame:
    """Refunds paid out, matched to the request by order and article."""
    timed = event_time(changes)
    paid = marked(rows_of(timed, "refund_payment", (), database).select(
        *fields("id", "order_id", "sku_id", "callback_time"), F.col("data")["payment_type"].alias("payment_type_code"),
        F.col("data")["total_amount"].alias("refund_amount"), "ts", "pt"))
    paid = paid.join(code_names(dictionary, "payment_type_code", "payment_type_name"), "payment_type_code")
    requests = marked(rows_of(timed, "order_refund_info", (), database).select(
        *fields("order_id", "sku_id", "refund_num"), F.col("pt").alias("request_pt")), "request_pt")
    rows = join_within(paid, requests, ["order_id", "sku_id"], "inner", within, "request_pt")
    turned = _orders_turned(timed, ORDER_REFUNDED, database, "user_id", "province_id")
    rows = join_within(rows, turned, ["order_id"], "inner", within, "order_pt")
    return rows.select(
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name",
        date_text(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num", "refund_amount", "ts",
        F.current_timestamp().alias("row_op_ts"))


def registrations(changes: DataFrame, database: str | None = None) -> DataFrame:
    return rows_of(changes, "user_info", ["insert"], database).select(
        F.col("data")["id"].alias("user_id"), date_text(F.col("data")["create_time"]).alias("date_id"),
        *fields("create_time"), "ts")
