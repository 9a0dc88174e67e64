"""Tumbling event-time aggregates.

Each function takes frames with an event time ``rt`` and works on tables and
on streams; a stream gets the watermark ``delay``. Results carry ``stt`` and
``edt`` as text. Inputs that are united each get their own watermark: the one
that lags behind holds the windows open.

Distinct counts aggregate twice, by (window, keys, id) and then by (window,
keys). The ids of a hot key are spread over all tasks, no set is ever built,
and both levels combine before they shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopstream.functions.money import major, minor, total
from shopstream.functions.sketches import sketch
from shopstream.functions.times import TIME_FORMAT
from shopstream.operators.flags import daily_first, with_first_ever, with_returning

SIZE = "10 seconds"
DELAY = "2 seconds"


def on_time(df: DataFrame, delay: str, time: str = "rt") -> DataFrame:
    """Set the watermark of a stream; a table passes through."""
    return df.withWatermark(time, delay) if df.isStreaming else df


def stamped(aggregated: DataFrame) -> DataFrame:
    """Replace the window by its start and end as text."""
    rest = [c for c in aggregated.columns if c != "window"]
    return aggregated.select(
        F.date_format("window.start", TIME_FORMAT).alias("stt"),
        F.date_format("window.end", TIME_FORMAT).alias("edt"),
        *rest,
    )


def _in(size: str, time: str = "rt") -> Column:
    return F.window(time, size)


def _count(condition: Column) -> Column:
    return F.sum(condition.cast("long"))


def traffic_window(
    pages: DataFrame, visitors: DataFrame, bounces: DataFrame, size: str = SIZE, delay: str = "14 seconds",
) -> DataFrame:
    """Visitors, sessions, page views, time and bounces by version, channel, area and visitor type."""
    keys = ["vc", "ch", "ar", "is_new"]
    no, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def measures(df: DataFrame, uv: Column = no, sv: Column = no, pv: Column = no, dur: Column = no, uj: Column = no):
        return df.select(
            "rt", *keys, uv.alias("uv_ct"), sv.alias("sv_ct"), pv.alias("pv_ct"), dur.alias("dur_sum"), uj.alias("uj_ct"),
        )

    entry = F.col("last_page_id").isNull().cast("long")
    parts = [
        measures(visitors, uv=one),
        measures(bounces, uj=one),
        measures(pages, sv=entry, pv=one, dur=F.col("during_time")),
    ]
    union = reduce(DataFrame.unionByName, (on_time(p, delay) for p in parts))
    sums = [F.sum(c).alias(c) for c in ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]]
    return stamped(union.groupBy(_in(size), *keys).agg(*sums))


def page_view_window(firsts: DataFrame, size: str = SIZE, delay: str = DELAY,
                     home: str = "home", detail: str = "good_detail") -> DataFrame:
    """Unique visitors of the home and the detail page, from first rows per (visitor, page, day)."""
    page = F.col("page_id")
    return stamped(on_time(firsts, delay).groupBy(_in(size)).agg(
        _count(page == home).alias("home_uv_ct"), _count(page == detail).alias("good_detail_uv_ct"),
    ))


def page_firsts(pages: DataFrame, home: str = "home", detail: str = "good_detail") -> DataFrame:
    """First view per visitor, page and day of the two watched pages."""
    return daily_first(pages.where(F.col("page_id").isin(home, detail)), ["mid", "page_id"], "rt")


def keyword_rows(pages: DataFrame) -> DataFrame:
    """Search terms: pages reached from search that hold a keyword."""
    return pages.where("last_page_id = 'search' and item_type = 'keyword' and item is not null").select("item", "rt")


def keyword_window(
    searches: DataFrame, split: Column, source: str = "search", size: str = SIZE, delay: str = DELAY,
) -> DataFrame:
    """Count words per window. ``split`` gives the array of words of a row."""
    words = on_time(searches, delay).select("rt", F.explode(split).alias("keyword"))
    counts = words.groupBy(_in(size), "keyword").agg(F.count("*").alias("keyword_count"))
    return stamped(counts.select("window", F.lit(source).alias("source"), "keyword", "keyword_count"))


def login_rows(pages: DataFrame) -> DataFrame:
    """Pages that mean a login: a known user on an entry page or after the login page."""
    return pages.where("uid is not null and (last_page_id = 'login' or last_page_id is null)")


def login_firsts(logins: DataFrame, back_days: int = 8) -> DataFrame:
    return with_returning(daily_first(logins, ["uid"], "rt"), "uid", back_days)


def login_window(firsts: DataFrame, size: str = SIZE, delay: str = "0 seconds") -> DataFrame:
    """Active users and users back after a pause, from first rows per (user, day)."""
    return stamped(on_time(firsts, delay).groupBy(_in(size)).agg(
        _count(F.col("is_back")).alias("back_ct"), F.count("*").alias("uu_ct"),
    ))


def register_window(registrations: DataFrame, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    return stamped(on_time(registrations, delay).groupBy(_in(size)).agg(F.count("*").alias("register_ct")))


def cart_firsts(carts: DataFrame) -> DataFrame:
    return daily_first(carts, ["user_id"], "rt")


def cart_window(firsts: DataFrame, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """Users who filled a cart, from first rows per (user, day)."""
    return stamped(on_time(firsts, delay).groupBy(_in(size)).agg(F.count("*").alias("cart_add_uu_ct")))


def payment_firsts(payments: DataFrame) -> DataFrame:
    return with_first_ever(daily_first(payments, ["user_id"], "rt"), "user_id")


def payment_window(firsts: DataFrame, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """Paying users and first-time payers, from first rows per (user, day)."""
    return stamped(on_time(firsts, delay).groupBy(_in(size)).agg(
        F.count("*").alias("payment_suc_unique_user_count"),
        _count(F.col("is_first_ever")).alias("payment_suc_new_user_count"),
    ))


def _order_amounts() -> list[Column]:
    units = F.coalesce(minor(F.col("split_activity_amount")), F.lit(0).cast("long"))
    coupon = F.coalesce(minor(F.col("split_coupon_amount")), F.lit(0).cast("long"))
    original = F.col("sku_num").try_cast("long") * minor(F.col("order_price"))
    return [F.sum(units).alias("_activity"), F.sum(coupon).alias("_coupon"), F.sum(original).alias("_original")]


def _order_totals(parts: DataFrame, unique: Column, new: Column) -> DataFrame:
    return stamped(parts.groupBy("window").agg(
        F.sum(unique).alias("order_unique_user_count"),
        F.sum(new).alias("order_new_user_count"),
        total(F.col("_activity")).alias("order_activity_reduce_amount"),
        total(F.col("_coupon")).alias("order_coupon_reduce_amount"),
        total(F.col("_original")).alias("order_origin_total_amount"),
    ))


def order_window(details: DataFrame, size: str = SIZE) -> DataFrame:
    """Ordering users, new users and amounts of a table of order details.

    Details are first reduced to (user, day, window), amounts and all. A
    user's flags then follow from the order of these rows, whose number is
    bounded by the windows in the data and not by the user's orders.
    """
    by_user = (
        details.groupBy("user_id", F.to_date("rt").alias("dt"), _in(size)).agg(*_order_amounts())
        .withColumn("_before", F.lag("dt").over(Window.partitionBy("user_id").orderBy("dt", "window.start")))
    )
    unique = F.col("_before").isNull() | (F.col("_before") != F.col("dt"))
    return _order_totals(by_user, unique.cast("long"), F.col("_before").isNull().cast("long"))


def order_window_from_firsts(
    details: DataFrame, firsts: DataFrame, size: str = SIZE, delay: str = DELAY,
) -> DataFrame:
    """The same totals from details and their flagged first rows per (user, day).

    This is the form for streams: flags come from keyed state, amounts do not
    pass through it, and both meet in one window.
    """
    none = F.lit(None)
    sums = details.select("rt", "split_activity_amount", "split_coupon_amount", "sku_num", "order_price",
                          none.cast("boolean").alias("is_first_ever"), F.lit(0).cast("long").alias("_unique"))
    users = firsts.select("rt", *(none.cast(sums.schema[c].dataType).alias(c) for c in sums.columns[1:5]),
                          "is_first_ever", F.lit(1).cast("long").alias("_unique"))
    union = on_time(sums, delay).unionByName(on_time(users, delay))
    parts = union.groupBy(_in(size)).agg(
        *_order_amounts(), F.sum("_unique").alias("_unique"),
        F.sum(F.coalesce(F.col("is_first_ever"), F.lit(False)).cast("long")).alias("_new"))

    def units(name: str) -> Column:
        return major(F.coalesce(F.col(name), F.lit(0).cast("long")))

    return stamped(parts.select(
        "window",
        F.col("_unique").alias("order_unique_user_count"),
        F.col("_new").alias("order_new_user_count"),
        units("_activity").alias("order_activity_reduce_amount"),
        units("_coupon").alias("order_coupon_reduce_amount"),
        units("_original").alias("order_origin_total_amount"),
    ))


def _orders_and_amount(df: DataFrame, keys: list[str], size: str, delay: str) -> DataFrame:
    per_order = on_time(df, delay).groupBy(_in(size), *keys, "order_id").agg(
        F.sum(minor(F.col("split_total_amount"))).alias("_amount"))
    return per_order.groupBy("window", *keys).agg(
        F.count("order_id").alias("order_count"), total(F.col("_amount")).alias("order_amount"))


def province_window(details: DataFrame, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """Distinct orders and amount by province; the name is joined to the result."""
    return stamped(_orders_and_amount(details, ["province_id"], size, delay))


def sketch_window(rows: DataFrame, keys: list[str], counted: str, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """A mergeable sketch of the different ``counted`` values per window and ``keys``, as ``<counted>_sketch``."""
    grouped = on_time(rows, delay).groupBy(_in(size), *keys)
    return stamped(grouped.agg(sketch(counted).alias(f"{counted}_sketch")))


def user_spu_window(details: DataFrame, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """Distinct orders and amount by user, product, trademark and category."""
    keys = ["trademark_id", "category3_id", "user_id", "spu_id"]
    return stamped(_orders_and_amount(details, keys, size, delay))


def refund_window(refunds: DataFrame, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """Distinct refunded orders by user, trademark and category."""
    keys = ["trademark_id", "category3_id", "user_id"]
    per_order = on_time(refunds, delay).groupBy(_in(size), *keys, "order_id").agg(F.count("*").alias("_rows"))
    return stamped(per_order.groupBy("window", *keys).agg(F.count("order_id").alias("refund_count")))


def sum_window(df: DataFrame, keys: list[str], value: str, size: str = "5 seconds", delay: str = DELAY) -> DataFrame:
    """Plain keyed sum per window."""
    return stamped(on_time(df, delay).groupBy(_in(size), *keys).agg(F.sum(value).alias(value)))
