import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shopstream.plans import reports
from shopstream.plans.warehouse import Stored
from tests.conftest import rows

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def traffic(spark, *data):
    return spark.createDataFrame(
        list(data), "stt string, ch string, is_new string, uv_ct long, sv_ct long, pv_ct long, dur_sum long, uj_ct long")


@pytest.fixture()
def visits(spark):
    return traffic(
        spark,
        ("2024-01-01 00:00:00", "web", "1", 3, 4, 10, 8000, 1), ("2024-01-01 05:00:10", "web", "0", 1, 0, 2, 100, 0),
        ("2024-01-01 05:00:20", "app", "0", 9, 0, 1, 0, 0), ("2024-01-02 23:00:00", "app", "1", 2, 1, 1, 50, 1))


def test_channels_are_sorted_and_guard_zero_sessions(visits):
    got = [tuple(r) for r in reports.channel_visitors(visits, D1).collect()]
    assert got == [(D1, "app", 9), (D1, "web", 4)]
    assert rows(reports.channel_pages_per_session(visits, "2024-01-01"), "ch", "pv_per_session") == [("app", None), ("web", 3.0)]
    assert rows(reports.channel_bounce_rate(visits), "dt", "ch", "uj_rate") == [(D1, "app", None), (D1, "web", 0.25), (D2, "app", 1.0)]
    assert rows(reports.channel_time_per_session(visits, D1), "ch", "dur_per_session") == [("app", None), ("web", 2025.0)]
    assert rows(reports.channel_sessions(visits, D1), "ch", "sv_ct") == [("app", 0), ("web", 4)]
    assert rows(reports.channel_visitors_and_bounces(visits, D2)) == [(D2, "app", 2, 1)]


def test_visitor_types(visits):
    got = rows(reports.visitor_types(visits, D1), "is_new", "uv_ct", "uj_rate", "avg_dur_sum", "avg_pv_ct")
    assert got == [("0", 10, 0.0, 0.0, 0.0), ("1", 3, 0.25, 2.0, 2.5)]
    table = {r.type: (r.new, r.old) for r in reports.visitor_type_table(visits, D1).collect()}
    assert table["访客数(人)"] == (3.0, 10.0) and table["跳出率(%)"] == (0.25, 0.0) and len(table) == 5
    only_new = {r.type: (r.new, r.old) for r in reports.visitor_type_table(visits, D2).collect()}
    assert only_new["总访问页面数(次)"] == (1.0, None)


def test_hours_are_filled(visits):
    assert rows(reports.hourly_visitors(visits, D1), "hr", "uv_ct", "pv_ct", "new_uv_ct") == [(0, 3, 10, 3), (5, 10, 3, 0)]
    filled = rows(reports.hourly_visitors_filled(visits), "dt", "hr", "uv_ct")
    assert len(filled) == 48
    assert [r for r in filled if r[2]] == [(D1, 0, 3), (D1, 5, 10), (D2, 23, 2)]


def test_day_filter_uses_the_partition_column_when_there_is_one(visits):
    stored = visits.withColumn("dt", F.col("stt").cast("date"))
    assert rows(reports.channel_visitors(stored, D2)) == rows(reports.channel_visitors(visits, D2)) == [(D2, "app", 2)]


def test_today(spark):
    now = datetime.now().strftime("%Y-%m-%d 00:00:00")
    df = traffic(spark, (now, "web", "1", 1, 1, 1, 1, 1), ("2001-01-01 00:00:00", "web", "1", 1, 1, 1, 1, 1))
    with_today = spark.sql("select current_date() as d").first().d
    got = rows(reports.channel_visitors(df, reports.TODAY), "dt")
    assert got == ([(with_today,)] if str(with_today) == now[:10] else got)


@pytest.fixture()
def orders(spark):
    return spark.createDataFrame([
        ("2024-01-01 00:00:00", "1", "A", "c1", "c2", "c3", "N1", "N2", "N3", "u1", "s1", "S1", 2, 10.10),
        ("2024-01-01 00:00:10", "1", "A", "c1", "c2", "c3", "N1", "N2", "N3", "u1", "s2", "S2", 1, 0.20),
        ("2024-01-01 00:00:10", "2", "B", "c1", "c2", "c4", "N1", "N2", "N4", "u2", "s3", "S3", 1, 99.00),
        ("2024-01-02 00:00:10", "2", "B", "c1", "c2", "c4", "N1", "N2", "N4", "u2", "s3", "S3", 1, 1.00),
    ], "stt string, trademark_id string, trademark_name string, category1_id string, category2_id string, category3_id string, "
       "category1_name string, category2_name string, category3_name string, user_id string, spu_id string, spu_name string, "
       "order_count long, order_amount double")


@pytest.fixture()
def refunds(spark):
    return spark.createDataFrame([
        ("2024-01-01 00:00:00", "1", "A", "c1", "c2", "c3", "N1", "N2", "N3", "u1", 1),
        ("2024-01-01 00:00:00", "3", "C", "c1", "c2", "c9", "N1", "N2", "N9", "u4", 2),
        ("2024-01-01 00:00:00", "3", "C", "c1", "c2", "c9", "N1", "N2", "N9", "u5", 2),
    ], "stt string, trademark_id string, trademark_name string, category1_id string, category2_id string, category3_id string, "
       "category1_name string, category2_name string, category3_name string, user_id string, refund_count long")


def test_goods_reports_show_both_sides(orders, refunds):
    assert rows(reports.trademark_stats(orders, refunds, D1)) == [
        (D1, "A", 3, 1, 10.3, 1, 1), (D1, "B", 1, 1, 99.0, 0, 0), (D1, "C", 0, 0, 0.0, 4, 2)]
    assert rows(reports.category_stats(orders, refunds, D1), "category3_name", "order_count", "refund_count") == [
        ("N3", 3, 1), ("N4", 1, 0), ("N9", 0, 4)]


def test_amounts_and_top(orders):
    assert rows(reports.trademark_amounts(orders, D1)) == [(D1, "A", 10.3), (D1, "B", 99.0)]
    assert rows(reports.top_trademarks(orders, D1, limit=1)) == [(D1, "B", 99.0)]
    assert len(rows(reports.top_trademarks(orders))) == 3
    assert rows(reports.spu_stats(orders, D1), "spu_name", "order_count", "uu_count") == [("S1", 2, 1), ("S2", 1, 1), ("S3", 1, 1)]


def test_trade_rows(orders, refunds):
    assert rows(reports.trade_stats(orders, refunds, D1), "type", "value") == sorted([("下单数", 4), ("下单人数", 2), ("退单数", 5), ("退单人数", 3)])


def test_provinces(spark):
    df = spark.createDataFrame([
        ("2024-01-01 00:00:00", "1", "North", 2, 1.5), ("2024-01-01 00:00:10", "1", "North", 1, 1.0),
        ("2024-01-01 00:00:10", "2", "", 1, 7.0), ("2024-01-01 00:00:10", "3", None, 1, 3.0),
    ], "stt string, province_id string, province_name string, order_count long, order_amount double")
    assert rows(reports.total_amount(df)) == [(D1, 12.5)]
    assert rows(reports.province_orders(df), "province_name", "order_count") == [(None, 1), ("", 1), ("North", 3)]
    assert rows(reports.province_amounts(df), "province_name", "order_amount") == [("North", 2.5)]


def test_subsidy(spark):
    df = spark.createDataFrame([
        ("2024-01-01 00:00:00", 1.0, 0.5, 8.0), ("2024-01-01 00:00:10", 1.0, 0.0, 8.0), ("2024-01-02 00:00:00", 0.0, 0.0, 0.0),
    ], "stt string, order_activity_reduce_amount double, order_coupon_reduce_amount double, order_origin_total_amount double")
    assert rows(reports.activity_stats(df)) == [(D1, 2.0, 16.0, 0.125), (D2, 0.0, 0.0, None)]
    assert rows(reports.coupon_stats(df, D1)) == [(D1, 0.5, 16.0, 0.03125)]


def test_keyword_weights_ignore_case(spark):
    df = spark.createDataFrame([
        ("2024-01-01 00:00:00", "search", "red", 2), ("2024-01-01 00:00:00", "ORDER", "red", 1), ("2024-01-01 00:00:00", "CART", "blue", 1),
        ("2024-01-01 00:00:00", "CLICK", "blue", 3), ("2024-01-01 00:00:00", "other", "grey", 9),
    ], "stt string, source string, keyword string, keyword_count long")
    assert [tuple(r) for r in reports.keyword_scores(df, D1).collect()] == [(D1, "red", 25), (D1, "blue", 5), (D1, "grey", 0)]


def test_user_reports(spark):
    def dws(columns, *values):
        return spark.createDataFrame([("2024-01-01 00:00:00", *values), ("2024-01-01 10:00:00", *values)], "stt string, " + columns)

    pages = dws("home_uv_ct long, good_detail_uv_ct long", 3, 2)
    carts, pays = dws("cart_add_uu_ct long", 4), dws("payment_suc_unique_user_count long, payment_suc_new_user_count long", 6, 7)
    bought = dws("order_unique_user_count long, order_new_user_count long", 5, 1)
    assert rows(reports.funnel(pages, carts, bought, pays, D1), "page_id", "uv_ct") == [
        ("cart", 8), ("good_detail", 4), ("home", 6), ("payment", 12), ("trade", 10)]
    logins, registers = dws("back_ct long, uu_ct long", 1, 9), dws("register_ct long", 2)
    assert rows(reports.user_changes(logins, registers), "type", "user_ct") == [("activeUserCt", 18), ("backCt", 2), ("newUserCt", 4)]
    assert rows(reports.new_trade_users(bought, pays), "trade_type", "user_ct") == [("order", 2), ("payment", 14)]


def test_stored_tables_follow_their_source(spark, tmp_path):
    """A source table that is written anew gives new summary tables."""
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).write.parquet(f"{tmp_path}/documents.parquet")
    before = Stored(spark, str(tmp_path)).keywords()
    assert Stored(spark, str(tmp_path)).keywords() is before
    time.sleep(1.1)  # file systems may tell whole seconds only
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    after = Stored(spark, str(tmp_path)).keywords()
    assert after is not before and after.count() > before.count()
