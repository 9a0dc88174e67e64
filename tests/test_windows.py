import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shopstream.functions.keywords import words
from shopstream.operators import flags, windows
from tests.conftest import at, rows

START = at("2024-01-01T23:59:30")


def bucket(t, seconds):
    base = at("2024-01-01")
    return base + timedelta(seconds=int((t - base).total_seconds()) // seconds * seconds)


def stamp(t):
    return t.strftime("%Y-%m-%d %H:%M:%S")


def random_details(seed, n=500):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        user = "hot" if rnd.random() < 0.34 else f"u{rnd.randrange(30)}"
        out.append((user, START + timedelta(milliseconds=rnd.randrange(90_000)), f"o{rnd.randrange(60)}", rnd.randrange(1, 5),
                    rnd.randrange(100, 99999) / 100, rnd.choice([None, 0.1, 0.25]), rnd.choice([None, 1.15]), f"p{rnd.randrange(3)}"))
    return out


COLUMNS = ("user_id string, rt timestamp, order_id string, sku_num int, order_price double, split_activity_amount double, "
           "split_coupon_amount double, province_id string")


def brute_orders(data, seconds):
    seen_days, seen, out = set(), set(), {}
    for user, rt, _, num, price, act, cou, _ in sorted(data, key=lambda r: r[1]):
        row = out.setdefault(bucket(rt, seconds), [0, 0, 0, 0, 0])
        row[0] += (user, rt.date()) not in seen_days
        row[1] += user not in seen
        seen_days.add((user, rt.date()))
        seen.add(user)
        for i, v in enumerate([round((act or 0) * 100), round((cou or 0) * 100), num * round(price * 100)]):
            row[2 + i] += v
    return sorted((stamp(t), stamp(t + timedelta(seconds=seconds)), r[0], r[1], r[2] / 100, r[3] / 100, r[4] / 100) for t, r in out.items())


@pytest.mark.parametrize("seconds", [10, 7])
def test_order_window_across_midnight(spark, seconds):
    data = random_details(seconds)
    df = spark.createDataFrame(data, COLUMNS)
    if seconds == 7:  # windows count from 1970, not from midnight
        got = windows.order_window(df, f"{seconds} seconds").agg(
            F.sum("order_unique_user_count"), F.sum("order_new_user_count"), F.sum(F.round(F.col("order_origin_total_amount") * 100).cast("long")))
        want = brute_orders(data, 10)
        assert tuple(got.first()) == (sum(r[2] for r in want), sum(r[3] for r in want), sum(round(r[6] * 100) for r in want))
    else:
        assert rows(windows.order_window(df, f"{seconds} seconds")) == brute_orders(data, seconds)


def test_order_window_forms_agree(spark):
    df = spark.createDataFrame(random_details(3), COLUMNS)
    firsts = flags.with_first_ever(flags.daily_first(df, ["user_id"], "rt"), "user_id")
    assert rows(windows.order_window_from_firsts(df, firsts)) == rows(windows.order_window(df))


def test_distinct_orders_and_amount_by_province(spark):
    data = random_details(4)
    df = spark.createDataFrame(data, COLUMNS).withColumnRenamed("order_price", "split_total_amount")
    want = {}
    for _, rt, order, _, price, _, _, province in data:
        ids, cents = want.setdefault((bucket(rt, 10), province), (set(), [0]))
        ids.add(order)
        cents[0] += round(price * 100)
    assert rows(windows.province_window(df), "stt", "province_id", "order_count", "order_amount") == sorted(
        (stamp(t), p, len(ids), cents[0] / 100) for (t, p), (ids, cents) in want.items())


def test_user_spu_and_refund_windows(spark):
    df = spark.createDataFrame([
        ("tm", "c3", "u", "spu", "o1", "1.50", START), ("tm", "c3", "u", "spu", "o1", "2.00", START), ("tm", "c3", "u", "spu", "o2", "1.00", START),
        (None, None, "u", None, "o3", "4.00", START), ("tm", "c3", "u", "spu", "o1", "1.00", START + timedelta(seconds=10)),
    ], "trademark_id string, category3_id string, user_id string, spu_id string, order_id string, split_total_amount string, rt timestamp")
    assert rows(windows.user_spu_window(df), "stt", "trademark_id", "order_count", "order_amount") == [
        ("2024-01-01 23:59:30", None, 1, 4.0), ("2024-01-01 23:59:30", "tm", 2, 4.5), ("2024-01-01 23:59:40", "tm", 1, 1.0)]
    assert rows(windows.refund_window(df), "stt", "trademark_id", "refund_count") == [
        ("2024-01-01 23:59:30", None, 1), ("2024-01-01 23:59:30", "tm", 2), ("2024-01-01 23:59:40", "tm", 1)]


def test_traffic_window_unions_three_inputs(spark):
    page = spark.createDataFrame([
        ("v", "c", "a", "1", None, 5, START), ("v", "c", "a", "1", "home", 7, START + timedelta(seconds=9)),
        ("v", "c", "a", "0", None, 1, START), ("v", "c", "a", "1", None, 2, START + timedelta(seconds=10)),
    ], "vc string, ch string, ar string, is_new string, last_page_id string, during_time long, rt timestamp")
    got = windows.traffic_window(page, page.where("during_time = 5"), page.where("during_time = 1"))
    assert rows(got, "stt", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct") == [
        ("2024-01-01 23:59:30", "0", 0, 1, 1, 1, 1), ("2024-01-01 23:59:30", "1", 1, 1, 2, 12, 0), ("2024-01-01 23:59:40", "1", 0, 1, 1, 2, 0)]


def test_page_firsts_are_kept_apart(spark):
    df = spark.createDataFrame([
        ("m", "home", START), ("m", "home", START + timedelta(seconds=1)), ("m", "good_detail", START + timedelta(seconds=2)),
        ("m", "home", START + timedelta(seconds=31)), ("n", "home", START), ("n", "cart", START),
    ], "mid string, page_id string, rt timestamp")
    assert rows(windows.page_view_window(windows.page_firsts(df))) == [
        ("2024-01-01 23:59:30", "2024-01-01 23:59:40", 2, 1), ("2024-01-02 00:00:00", "2024-01-02 00:00:10", 1, 0)]


def test_keywords_come_from_search_pages(spark):
    df = spark.createDataFrame([
        ("search", "keyword", "Red phone", START), ("search", "keyword", "red", START), ("search", "sku_id", "red", START),
        ("home", "keyword", "red", START), ("search", "keyword", None, START), (None, "keyword", "red", START),
    ], "last_page_id string, item_type string, item string, rt timestamp")
    got = windows.keyword_window(windows.keyword_rows(df), words(F.col("item")))
    assert rows(got, "source", "keyword", "keyword_count") == [("search", "phone", 1), ("search", "red", 2)]


def test_login_rows(spark):
    df = spark.createDataFrame([
        ("u", None, 1), ("u", "login", 2), ("u", "home", 3), (None, None, 4), (None, "login", 5)], "uid string, last_page_id string, n int")
    assert rows(windows.login_rows(df), "n") == [(1,), (2,)]


def test_payment_and_cart_and_register_windows(spark):
    data = [("a", START), ("a", START + timedelta(seconds=5)), ("a", START + timedelta(seconds=40)), ("b", START + timedelta(seconds=41))]
    df = spark.createDataFrame(data, "user_id string, rt timestamp")
    assert rows(windows.payment_window(windows.payment_firsts(df)), "stt", "payment_suc_unique_user_count", "payment_suc_new_user_count") == [
        ("2024-01-01 23:59:30", 1, 1), ("2024-01-02 00:00:10", 2, 1)]
    assert rows(windows.cart_window(windows.cart_firsts(df)), "stt", "cart_add_uu_ct") == [
        ("2024-01-01 23:59:30", 1), ("2024-01-02 00:00:10", 2)]
    assert rows(windows.register_window(df), "stt", "register_ct") == [("2024-01-01 23:59:30", 2), ("2024-01-02 00:00:10", 2)]


def test_sum_window(spark):
    df = spark.createDataFrame([("s1", 2, START), ("s1", 3, START + timedelta(seconds=4)), ("s1", 5, START + timedelta(seconds=5))],
                               "id string, vc long, rt timestamp")
    assert rows(windows.sum_window(df, ["id"], "vc"), "stt", "vc") == [("2024-01-01 23:59:30", 5), ("2024-01-01 23:59:35", 5)]


def test_amounts_of_any_decimals_add_up(spark):
    data = [(f"u{i % 7}", START, f"o{i}", 1, 1.004, 0.004, 0.00025, "p") for i in range(1000)]
    df = spark.createDataFrame(data, COLUMNS)
    row = windows.order_window(df, "1 day").first()
    assert (row.order_activity_reduce_amount, row.order_coupon_reduce_amount, row.order_origin_total_amount) == (4.0, 0.25, 1004.0)
    amounts = df.withColumn("split_total_amount", F.col("order_price") * (1 - F.lit(0.07)))
    assert windows.province_window(amounts, "1 day").first().order_amount == 933.72
