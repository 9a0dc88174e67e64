"""The shape of the plans: what would hurt on a large cluster must not come back."""

import contextlib
import io
import re

import pytest

from shopstream.plans import catalog
from shopstream.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
WRITES = {"dim_upsert", "pay_upsert", "summary_table", "province_sketch"} | {f"{n}_day" for n in catalog.REPORTS}


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture()
def large(spark):
    """As if no table fitted a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Warehouse(spark, SF)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [n for n in catalog.OPERATORS if n not in WRITES])
def test_no_query_forces_a_broadcast_or_a_cross_join(large, name):
    text = plan(catalog.OPERATORS[name](large))
    for bad in ["BroadcastExchange", "BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition, ENSURE"]:
        assert bad not in text, bad
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["dedup_first", "dedup_last", "unique_visitor", "order_window", "province_window"])
def test_one_row_per_key_is_taken_before_the_shuffle(large, name):
    text = plan(catalog.OPERATORS[name](large))
    assert re.search(r"WindowGroupLimit [^\n]*Final.*?Exchange hashpartitioning.*?WindowGroupLimit [^\n]*Partial", text, re.S)


@pytest.mark.parametrize("name", ["daily_unique_user", "page_view_window", "login_window", "is_new_repair", "keyword_window", "order_flags"])
def test_aggregates_combine_before_the_shuffle(large, name):
    text = plan(catalog.OPERATORS[name](large))
    assert "partial_" in text and "SortAggregate" not in text


def test_a_source_table_is_scanned_once_per_change_topic(large):
    text = plan(catalog.OPERATORS["order_wide"](large))
    assert text.count("FileScan") <= 5 and text.count("orders.parquet") == 1
    assert plan(catalog.OPERATORS["refund_pay"](large)).count("FileScan") <= 4


def test_only_needed_columns_are_read(large):
    text = plan(catalog.OPERATORS["user_register"](large))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "user_id", "event_type", "value"}
    assert "EqualTo(event_type,signup)" in text


def test_traffic_shuffles_each_input_once(large):
    text = plan(large.traffic())
    assert text.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize("name", list(catalog.REPORTS))
def test_a_report_of_one_day_reads_that_partition(spark, name):
    text = plan(catalog.OPERATORS[f"{name}_day"](Warehouse(spark, SF)))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert filters and all("isnotnull(dt" in f and "(dt#" in f for f in filters)
