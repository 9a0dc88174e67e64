"""Retail frames derived from the star-schema tables.

The tables hold no app logs or change records, so these functions shape
``events``, ``orders``, ``lineitem``, ``customer`` and ``part`` into the inputs
the operators read. They are plain projections: what comes out grows with the
table that goes in.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions.times import TIME_FORMAT, time_of_ms
from shopstream.operators.dedup import first_by_key, last_by_key

PAGE_OF = {"view": "home", "click": "good_detail", "purchase": "trade", "error": "search", "signup": "login"}
PREVIOUS_OF = {"view": "search", "click": "home", "purchase": "good_detail", "error": "login"}

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


# Columns of rows that were dealt by time: the slice of time whose records they give.
AFTER, UPTO = "_after", "_upto"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its zone-less times read as instants of the session zone (set to UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return instants(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def instants(df: DataFrame) -> DataFrame:
    times = {n: F.col(n).cast("timestamp") for n, t in df.dtypes if t == "timestamp_ntz"}
    return df.withColumns(times) if times else df


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def amount(column: Column | str) -> Column:
    """A double as text with two decimals."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)").cast("string")


def time_text(column: Column | str) -> Column:
    return F.date_format(column, TIME_FORMAT)


def prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _lookup(names: dict[str, str]) -> Column:
    value = F.lit(None).cast("string")
    for key, name in names.items():
        value = F.when(F.col("event_type") == key, name).otherwise(value)
    return value


def page_log(events: DataFrame) -> DataFrame:
    """Flat page log: a signup is an entry page, small values claim a new visitor."""
    ms, k = F.unix_millis("ts"), prop_k()
    return events.select(
        text("user_id").alias("mid"), text("user_id").alias("uid"),
        F.concat(F.lit("v"), k % 2).alias("vc"), F.concat(F.lit("ch"), k % 5).alias("ch"),
        F.concat(F.lit("ar"), k % 3).alias("ar"),
        F.when(F.col("value") < 10, "1").otherwise("0").alias("is_new"),
        _lookup(PAGE_OF).alias("page_id"), _lookup(PREVIOUS_OF).alias("last_page_id"),
        F.round(F.col("value") * 100).cast("long").alias("during_time"),
        ms.alias("ts"), time_of_ms(ms).alias("rt"), "event_id",
    )


def log_lines(events: DataFrame) -> DataFrame:
    """Raw log text: JSON with nested displays and actions; cheap errors are cut off and so are no JSON."""
    ms = F.unix_millis("ts")
    base = events.select(
        "event_id", prop_k().alias("k"), F.col("value").alias("v"), F.col("event_type").alias("kind"), ms.alias("ts"),
        text("user_id").alias("mid"), _lookup(PAGE_OF).alias("page_id"), _lookup(PREVIOUS_OF).alias("last_page_id"))

    def items(n: Column, build) -> Column:
        none = F.array().cast("array<int>")
        return F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(none), build)

    line = F.to_json(F.struct(
        F.struct(
            "mid", F.col("mid").alias("uid"), F.concat(F.lit("v"), F.col("k") % 2).alias("vc"),
            F.concat(F.lit("ch"), F.col("k") % 5).alias("ch"), F.concat(F.lit("ar"), F.col("k") % 3).alias("ar"),
            F.when(F.col("v") < 10, "1").otherwise("0").alias("is_new")).alias("common"),
        F.struct("page_id", "last_page_id", F.round(F.col("v") * 100).cast("long").alias("during_time")).alias("page"),
        items(F.col("k") % 4, lambda i: F.struct(F.concat(F.lit("i"), i).alias("item"), i.alias("pos"))).alias("displays"),
        items(F.col("k") % 3, lambda i: F.struct(
            F.concat(F.lit("a"), i).alias("action_id"), (F.col("ts") + i * 10).alias("ts"))).alias("actions"),
        F.when((F.col("kind") == "signup") & (F.col("v") >= 80), F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(F.col("kind") == "error", F.struct(F.col("k").alias("error_code"))).alias("err"),
        "ts",
    ))
    broken = (F.col("kind") == "error") & (F.col("v") < 10)
    return base.select("event_id", F.when(broken, F.substring(line, 1, 20)).otherwise(line).alias("value"))


def _data(**columns: Column | str | None) -> Column:
    """String map of the named columns."""
    pairs = []
    for name, column in columns.items():
        value = F.lit(None) if column is None else (F.col(column) if isinstance(column, str) else column)
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs)


def _change(rows: DataFrame, table_name: str, kind: Column | str, data: Column, time: Column | str, old: Column | None = None) -> DataFrame:
    """Change records of one source table.

    The table name is a constant of its branch, so a reader that filters on it
    drops the other branches of a topic at planning time, and the keys it takes
    from ``data`` turn back into columns of the scan.
    """
    before = F.lit(None) if old is None else old
    if AFTER in rows.columns:
        rows = rows.where(in_slice(F.unix_timestamp(time)))
    return rows.select(
        F.lit("shop").alias("database"), F.lit(table_name).alias("table"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"), data.alias("data"),
        before.cast("map<string,string>").alias("old"), text(F.unix_timestamp(time)).alias("ts"))


def in_slice(stamp: Column) -> Column:
    """Whether a time lies in its row's slice of time: after ``AFTER``, up to ``UPTO``, without end where null. No time is of the first slice."""
    after, upto = F.col(AFTER), F.col(UPTO)
    inside = (after.isNull() | (stamp > after)) & (upto.isNull() | (stamp <= upto))
    return F.when(stamp.isNull(), after.isNull()).otherwise(inside)


def _topic(*branches: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, branches)


def shop_changes(events: DataFrame) -> DataFrame:
    """Change records of favourites, carts, coupons, users and comments, mixed as in one topic."""
    rows = events.withColumns({"k": prop_k(), "at": time_text("ts")})
    value, at, k = F.col("value"), F.col("at"), F.col("k")
    null = F.lit(None).cast("string")
    common = {"id": "event_id", "user_id": "user_id", "sku_id": k, "create_time": at}

    def of(kind: str) -> DataFrame:
        return rows.where(F.col("event_type") == kind)

    def inserted(below: int, otherwise: str = "update") -> Column:
        return F.when(value < below, "insert").otherwise(otherwise)

    favors = _change(
        of("view"), "favor_info", inserted(50), _data(**common, is_cancel=F.when(value < 70, "0").otherwise("1")), "ts")
    carts = _change(
        of("click"), "cart_info", inserted(30),
        _data(
            **common, cart_price=amount("value"), sku_num=k, sku_name=F.concat(F.lit("sku-"), k), is_checked=F.lit("1"),
            operate_time=F.when(value >= 30, at), is_ordered=F.lit("0"), order_time=null, source_type=k % 30, source_id="event_id"),
        "ts",
        F.when(value < 30, F.lit(None)).when(value < 80, _data(sku_num=F.lit("50"))).otherwise(_data(is_checked=F.lit("0"))))
    coupons = _change(
        of("purchase"), "coupon_use", inserted(20),
        _data(
            id="event_id", coupon_id=k, user_id="user_id", order_id=F.col("event_id") + 1000, get_time=at,
            using_time=F.when(value >= 20, at), used_time=F.when(value >= 60, at),
            coupon_status=F.when(value < 20, "1401").otherwise("1402")),
        "ts",
        F.when(value >= 20, _data(coupon_status=F.when(value < 60, "1401").otherwise("1402"))))
    users = _change(of("signup"), "user_info", inserted(80), _data(id="user_id", create_time=at), "ts")
    comments = _change(
        of("error"), "comment_info", inserted(80, "delete"),
        _data(**common, order_id=F.col("event_id") + 1000, appraise=k % 30), "ts")
    return _topic(favors, carts, coupons, users, comments)


def line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def detail_changes(lineitem: DataFrame, at: Callable[[str], Column] = lambda _: F.col("l_shipdate")) -> DataFrame:
    """Change records a line item gives rise to: the detail, its activity, coupon, refund request and refund payment.

    ``at`` gives the time of the records of a source table.
    """
    return _topic(*_detail_branches(lineitem, at).values())


def _detail_branches(lineitem: DataFrame, at: Callable[[str], Column]) -> dict[str, DataFrame]:
    rows = lineitem.withColumns({"id": line_id(), "at": time_text("l_shipdate")})
    part = {"order_id": "l_orderkey", "sku_id": "l_partkey", "create_time": "at"}
    returned = rows.where("l_returnflag = 'R'")
    details = _data(
        id="id", **part, sku_name=F.concat(F.lit("sku-"), text("l_partkey")), order_price=amount("l_extendedprice"),
        sku_num=F.col("l_quantity").cast("int"), source_type=F.col("l_suppkey") % 30, source_id="l_suppkey",
        split_total_amount=amount("l_extendedprice"), split_activity_amount=amount("l_discount"),
        split_coupon_amount=amount("l_tax"))
    activities = _data(
        id=F.concat(F.lit("a"), "id"), order_detail_id="id", **part,
        activity_id=F.round(F.col("l_discount") * 100).cast("int"), activity_rule_id="l_linenumber")
    coupons = _data(
        id=F.concat(F.lit("c"), "id"), order_detail_id="id", **part,
        coupon_id=F.round(F.col("l_tax") * 100).cast("int"), coupon_use_id="l_suppkey")
    refunds = _data(
        id=F.concat(F.lit("r"), "id"), user_id="l_suppkey", **part, refund_type=F.col("l_suppkey") % 30,
        refund_num=F.col("l_quantity").cast("int"), refund_amount=amount("l_extendedprice"),
        refund_reason_type="l_linenumber", refund_reason_txt="l_linestatus")
    payments = _data(
        id=F.concat(F.lit("p"), "id"), order_id="l_orderkey", sku_id="l_partkey", payment_type=F.col("l_suppkey") % 30,
        callback_time="at", total_amount=amount("l_extendedprice"))
    records = {
        "order_detail": (rows, details), "order_detail_activity": (rows.where("l_discount >= 0.05D"), activities),
        "order_detail_coupon": (rows.where("l_tax >= 0.04D"), coupons), "order_refund_info": (returned, refunds),
        "refund_payment": (returned.where("l_linestatus = 'F'"), payments)}
    return {name: _change(some, name, "insert", data, at(name)) for name, (some, data) in records.items()}


def order_changes(orders: DataFrame, at: Callable[[str], Column] = lambda _: F.col("o_orderdate")) -> DataFrame:
    """Change records of an order: insert, status updates by its final state, and its payment.

    One scan gives all records of an order; only source tables are branches.
    ``at`` gives the time of the records of a source table.
    """
    return _topic(*_order_branches(orders, at).values())


def _order_branches(orders: DataFrame, at: Callable[[str], Column]) -> dict[str, DataFrame]:
    rows = orders.withColumns({"at": time_text("o_orderdate"), "later": time_text(F.col("o_orderdate") + F.expr("interval 10 minutes"))})
    blank = {n: None for n in [
        "consignee_tel", "delivery_address", "order_comment", "out_trade_no", "trade_body", "expire_time",
        "process_status", "tracking_no", "parent_order_id", "activity_reduce_amount", "coupon_reduce_amount",
        "feight_fee", "feight_fee_reduce", "refundable_time"]}

    # the records an order's state implies: type, status, whether it was touched later, and what it was before
    def record(kind: str, status: str, before: Column | None) -> Column:
        old = F.lit(None) if before is None else before
        return F.struct(F.lit(kind).alias("kind"), F.lit(status).alias("status"), old.cast("map<string,string>").alias("old"))

    def turned(status: str, before: str) -> Column:
        return record("update", status, _data(order_status=F.lit(before)))

    records = F.concat(
        F.array(record("insert", "1001", None)),
        F.when(F.col("o_orderstatus") == "P", F.array(turned("1003", "1001")))
        .when(F.col("o_orderstatus") == "F", F.array(turned("1005", "1001"), turned("1006", "1005")))
        .when(F.col("o_orderstatus") == "O", F.array(turned("1002", "1001"), record("update", "1003", _data(operate_time="at"))))
        .otherwise(F.slice(F.array(turned("1002", "1001")), 1, 0)))  # no other records
    # texts are made once an order, below the explode: then the map holds plain columns, and a reader of its keys makes no map
    texts = {"_key": text("o_orderkey"), "_user": text("o_custkey"), "_name": F.concat(F.lit("Customer "), text("o_custkey")),
             "_total": amount("o_totalprice"), "_way": text("o_orderpriority"), "_province": text(F.col("o_custkey") % 25)}
    each = rows.withColumns(texts).withColumn("_record", F.explode(records))
    kind = F.col("_record.kind")
    order = _data(
        id="_key", consignee="_name", total_amount="_total", order_status=F.col("_record.status"), user_id="_user",
        payment_way="_way", create_time="at", operate_time=F.when(kind == "update", F.col("later")), province_id="_province",
        original_total_amount="_total", **blank)
    payments = _data(
        user_id="o_custkey", order_id="o_orderkey", payment_type=F.col("o_custkey") % 30, callback_time="later",
        payment_status=F.when(F.col("o_orderstatus") != "P", "1602").otherwise("1601"))
    return {
        "order_info": _change(each, "order_info", kind, order, at("order_info"), F.col("_record.old")),
        "payment_info": _change(rows, "payment_info", "update", payments, at("payment_info"))}


# Seconds after its order's time that a record of a source table comes, and how far apart records that belong together may be.
FEED_SECONDS = {
    "order_detail": 0, "order_detail_coupon": 120, "order_detail_activity": 300, "payment_info": 600, "order_refund_info": 900,
    "refund_payment": 1200,
}
FEED_RANGE = "30 minutes"


FEED_LAST = max(FEED_SECONDS.values())


def trade_feed(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The change records of orders and lines as they would come in, all within half an hour of their order.

    A line's ship date has nothing to do with its order's, so as a stream its
    records take their time from the order. Activities and refunds come late.
    """
    return trade_records(trade_rows(lineitem, orders))


def trade_rows(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows that the records of :func:`trade_feed` are made from, lines and orders under each other, with the time of the first."""
    made = orders.select(F.col("o_orderkey").alias("_order"), F.unix_timestamp("o_orderdate").alias("_made"))
    lines = lineitem.join(made, F.col("l_orderkey") == F.col("_order"), "left").drop("_order").withColumn(
        "_made", F.coalesce("_made", F.unix_timestamp("l_shipdate")) + 10 * F.col("l_linenumber"))
    timed = orders.withColumn("_made", F.unix_timestamp("o_orderdate"))
    return lines.withColumn("_line", F.lit(True)).unionByName(timed.withColumn("_line", F.lit(False)), allowMissingColumns=True)


def trade_records(rows: DataFrame, *tables: str) -> DataFrame:
    """The records that rows of :func:`trade_rows` give, of all source tables or of those named."""
    def of_line(name: str) -> Column:
        return F.timestamp_seconds(F.col("_made") + FEED_SECONDS[name])

    def of_order(name: str) -> Column:
        status = F.col("_record.status")
        late = F.when(status == "1006", 1200).when(status == "1005", 900).when(F.col("_record.kind") == "update", 300).otherwise(0)
        return F.timestamp_seconds(F.col("_made") + (late if name == "order_info" else FEED_SECONDS[name]))

    branches = _detail_branches(rows.where("_line"), of_line) | _order_branches(rows.where("not _line"), of_order)
    return _topic(*(branch for name, branch in branches.items() if not tables or name in tables))


def dictionary(nation: DataFrame) -> DataFrame:
    return nation.select(text("n_nationkey").alias("dic_code"), F.col("n_name").alias("dic_name"))


def part_changes(part: DataFrame) -> DataFrame:
    """Change records of articles; the record type follows the part's type."""
    kinds = F.create_map(*[F.lit(x) for pair in {
        "ECONOMY": "insert", "STANDARD": "update", "PROMO": "bootstrap-insert", "SMALL": "delete",
    }.items() for x in pair])
    data = _data(id="p_partkey", name="p_name", tm_id="p_brand", size="p_size", price=amount("p_retailprice"))
    kind = F.coalesce(F.try_element_at(kinds, F.col("p_type")), F.lit("bootstrap-start"))
    return _change(part.withColumn("at", F.timestamp_seconds(F.col("p_size"))), "part", kind, data, "at")


def customer_changes(customer: DataFrame) -> DataFrame:
    data = _data(id="c_custkey", name="c_name", nation="c_nationkey", segment="c_mktsegment")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "update").otherwise("insert")
    return _change(customer.withColumn("at", F.timestamp_seconds(F.col("c_nationkey"))), "customer", kind, data, "at")


# Dimensions. Articles carry a product, a trademark and a third-level category;
# categories nest as nation, region, first letter of the region.

def dim_sku(part: DataFrame) -> DataFrame:
    return part.select(
        text("p_partkey").alias("id"), F.col("p_name").alias("spu_id"), F.col("p_brand").alias("tm_id"),
        text(F.col("p_size") - 1).alias("category3_id"))


def dim_spu(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_name").alias("id"), F.upper("p_name").alias("spu_name")).distinct()


def dim_trademark(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_brand").alias("id"), F.concat(F.lit("TM "), "p_brand").alias("tm_name")).distinct()


def dim_category3(nation: DataFrame) -> DataFrame:
    return nation.select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"), text("n_regionkey").alias("category2_id"))


def dim_category2(region: DataFrame) -> DataFrame:
    return region.select(text("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.substring("r_name", 1, 1).alias("category1_id"))


def dim_category1(region: DataFrame) -> DataFrame:
    letter = F.substring("r_name", 1, 1)
    return region.select(letter.alias("id"), F.concat(F.lit("group "), letter).alias("name")).distinct()


def dim_province(nation: DataFrame) -> DataFrame:
    return nation.select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


# Typed facts. A line (order, number) occurs more than once, as a replayed
# detail does; it is reduced before the join, so an order's few lines meet it.

def first_lines(lineitem: DataFrame) -> DataFrame:
    return first_by_key(lineitem, LINE_KEY, ["l_shipdate", *LINE_REST])


def last_lines(lineitem: DataFrame) -> DataFrame:
    return last_by_key(lineitem, LINE_KEY, "l_shipdate", LINE_REST)


def line_facts(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order details with the order's user and time."""
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"), text("l_partkey").alias("sku_id"), text("o_custkey").alias("user_id"),
        F.col("l_quantity").cast("int").alias("sku_num"), F.col("l_extendedprice").alias("order_price"),
        F.col("l_extendedprice").alias("split_total_amount"), F.col("l_discount").alias("split_activity_amount"),
        F.when(F.col("l_tax") >= 0.04, F.col("l_tax")).alias("split_coupon_amount"),
        "o_custkey", "o_orderstatus", F.col("o_orderdate").alias("rt"))


def payments(facts: DataFrame) -> DataFrame:
    """Details of paid orders, ten minutes after the order."""
    paid = facts.where("o_orderstatus <> 'P'")
    return paid.withColumn("rt", F.col("rt") + F.expr("interval 10 minutes"))


def with_province(facts: DataFrame, customer: DataFrame) -> DataFrame:
    homes = customer.select(F.col("c_custkey").alias("o_custkey"), text("c_nationkey").alias("province_id"))
    return facts.join(homes, "o_custkey")


def refund_facts(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    returned = lineitem.where("l_returnflag = 'R'").select("l_orderkey", "l_partkey", "l_shipdate")
    users = orders.select("o_orderkey", "o_custkey")
    return returned.join(users, returned.l_orderkey == users.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"), text("l_partkey").alias("sku_id"), text("o_custkey").alias("user_id"),
        F.col("l_shipdate").alias("rt"))
