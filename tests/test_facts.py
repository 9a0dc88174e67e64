import pytest

from shopstream.operators import facts
from shopstream.schemas import CHANGE
from tests.conftest import rows


def change(table, kind, data, old=None, ts="1704067200", database="shop"):
    return (database, table, kind, {k: None if v is None else str(v) for k, v in data.items()}, old, ts)


@pytest.fixture()
def dic(spark):
    return spark.createDataFrame([("1", "one"), ("2", "two"), ("3", "three")], "dic_code string, dic_name string")


def topic(spark, *records):
    return spark.createDataFrame(list(records), CHANGE)


T = "2024-01-01 10:00:00"


def test_comment_needs_a_known_code(spark, dic):
    df = topic(
        spark,
        change("comment_info", "insert", {"id": 1, "user_id": 5, "create_time": T, "appraise": 2}),
        change("comment_info", "insert", {"id": 2, "create_time": T, "appraise": 99}),
        change("comment_info", "update", {"id": 3, "create_time": T, "appraise": 2}),
        change("other", "insert", {"id": 4, "create_time": T, "appraise": 2}))
    assert rows(facts.comments(df, dic)) == [("1", "5", None, None, "2024-01-01", T, "2", "two", "1704067200")]


def test_database_filter(spark):
    df = topic(spark, change("user_info", "insert", {"id": 1, "create_time": T}),
               change("user_info", "insert", {"id": 2, "create_time": T}, database="elsewhere"))
    assert rows(facts.registrations(df, "shop"), "user_id", "date_id") == [("1", "2024-01-01")]
    assert facts.registrations(df).count() == 2


def test_favorites_count_again_after_a_cancel(spark):
    df = topic(
        spark,
        change("favor_info", "insert", {"id": 1, "is_cancel": "0"}),
        change("favor_info", "insert", {"id": 2}),
        change("favor_info", "update", {"id": 3, "is_cancel": "0"}),
        change("favor_info", "update", {"id": 4, "is_cancel": "1"}),
        change("favor_info", "update", {"id": 5}),
        change("favor_info", "delete", {"id": 6, "is_cancel": "0"}))
    assert rows(facts.favorites(df), "id") == [("1",), ("2",), ("3",)]


def test_coupons(spark):
    df = topic(
        spark,
        change("coupon_use", "insert", {"id": 1, "get_time": T, "coupon_status": 1401}),
        change("coupon_use", "update", {"id": 2, "using_time": T, "coupon_status": 1402}, {"coupon_status": "1401"}),
        change("coupon_use", "update", {"id": 3, "using_time": T, "coupon_status": 1402}, {"using_time": None}),
        change("coupon_use", "update", {"id": 4, "using_time": T, "coupon_status": 1402}),
        change("coupon_use", "update", {"id": 5, "used_time": T, "coupon_status": 1403}, {"coupon_status": "1402"}))
    assert rows(facts.coupons_got(df), "id", "get_time") == [("1", T)]
    assert rows(facts.coupons_ordered(df), "id", "order_time") == [("2", T)]
    assert rows(facts.coupons_paid(df), "id", "payment_time", "date_id") == [("5", T, "2024-01-01")]


def test_cart_takes_the_raise(spark, dic):
    def cart(i, kind, num, old=None, source=1):
        return change("cart_info", kind, {"id": i, "sku_num": num, "source_type": source}, old)

    df = topic(
        spark, cart(1, "insert", 3), cart(2, "update", 5, {"sku_num": "2"}), cart(3, "update", 2, {"sku_num": "5"}),
        cart(4, "update", 2, {"sku_num": "2"}), cart(5, "update", 2, {"is_checked": "0"}), cart(6, "update", 10, {"sku_num": "9"}),
        cart(7, "insert", 1, source=42), cart(8, "update", 2), cart(9, "delete", 2))
    assert rows(facts.cart_adds(df, dic), "id", "sku_num", "source_type_name") == [("1", "3", "one"), ("2", "3", "one"), ("6", "1", "one")]


def orders(spark):
    return topic(
        spark,
        change("order_detail", "insert", {"id": 1, "order_id": 10, "sku_id": 7, "source_type": 1, "sku_num": 2, "order_price": "5.00"}),
        change("order_detail", "insert", {"id": 2, "order_id": 10, "sku_id": 8, "source_type": 2}),
        change("order_detail", "insert", {"id": 3, "order_id": 11, "sku_id": 7, "source_type": 1}),
        change("order_detail", "insert", {"id": 4, "order_id": 10, "sku_id": 9, "source_type": 77}),
        change("order_detail", "insert", {"id": 5, "order_id": 99, "sku_id": 9, "source_type": 1}),
        change("order_info", "insert", {"id": 10, "user_id": 100, "province_id": 3, "order_status": 1001}),
        change("order_info", "insert", {"id": 11, "user_id": 101, "province_id": 4, "order_status": 1001}),
        change("order_info", "update", {"id": 11, "user_id": 101, "order_status": 1003, "operate_time": T}, {"order_status": "1001"}),
        change("order_info", "update", {"id": 10, "user_id": 100, "order_status": 1003}, {"tracking_no": "x"}),
        change("order_info", "update", {"id": 10, "user_id": 100, "province_id": 3, "order_status": 1005}, {"order_status": "1002"}),
        change("order_info", "update", {"id": 10, "user_id": 100, "province_id": 3, "order_status": 1006}, {"order_status": "1005"}),
        change("order_info", "delete", {"id": 10}),
        change("order_detail_activity", "insert", {"id": 50, "order_detail_id": 1, "activity_id": 6}),
        change("order_detail_coupon", "insert", {"id": 60, "order_detail_id": 2, "coupon_id": 4}),
        change("payment_info", "update", {"order_id": 10, "payment_type": 3, "payment_status": 1602, "callback_time": T}),
        change("payment_info", "update", {"order_id": 11, "payment_type": 3, "payment_status": 1601, "callback_time": T}),
        change("payment_info", "update", {"order_id": 11, "payment_type": 88, "payment_status": 1602, "callback_time": T}),
        change("order_refund_info", "insert", {"id": 70, "order_id": 10, "sku_id": 7, "refund_type": 1, "refund_reason_type": 2,
                                               "refund_num": 1, "create_time": T}),
        change("order_refund_info", "insert", {"id": 71, "order_id": 11, "sku_id": 7, "refund_type": 1, "refund_reason_type": 2}),
        change("order_refund_info", "insert", {"id": 72, "order_id": 10, "sku_id": 8, "refund_type": 1, "refund_reason_type": 90}),
        change("refund_payment", "insert", {"id": 80, "order_id": 10, "sku_id": 7, "payment_type": 3, "callback_time": T, "total_amount": "5.00"}),
        change("refund_payment", "insert", {"id": 81, "order_id": 10, "sku_id": 99, "payment_type": 3}),
    )


def test_order_wide_and_its_readers(spark, dic):
    wide = facts.order_wide(orders(spark), dic).cache()
    # 5 order records of order 10 for details 1 and 2, 2 of order 11 for detail 3
    assert wide.count() == 2 * 4 + 2
    first = wide.where("id = '1' and type = 'insert'").first()
    assert (first.activity_id, first.coupon_id, first.source_type_name, first.user_id) == ("6", None, "one", "100")
    assert rows(facts.order_details(wide), "id", "activity_id", "coupon_id", "province_id") == [
        ("1", "6", None, "3"), ("2", None, "4", "3"), ("3", None, None, "4")]
    assert rows(facts.cancelled_details(wide), "id", "order_id", "cancel_time") == [("3", "11", T)]
    wide.unpersist()


def test_paid_details(spark, dic):
    df = orders(spark)
    paid = facts.paid_details(df, facts.order_details(facts.order_wide(df, dic)), dic)
    assert rows(paid, "order_detail_id", "payment_type_name", "callback_time") == [("1", "three", T), ("2", "three", T)]


def test_refunds(spark, dic):
    df = orders(spark)
    assert rows(facts.refunds(df, dic), "id", "province_id", "refund_type_name", "refund_reason_type_name", "date_id") == [
        ("70", "3", "one", "two", "2024-01-01")]
    assert rows(facts.refunds_paid(df, dic), "id", "user_id", "refund_num", "refund_amount", "payment_type_name") == [
        ("80", "100", "1", "5.00", "three")]
