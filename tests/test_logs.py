import json
import random

import pytest
from pyspark.sql import functions as F

from shopstream.functions.times import time_of_ms
from shopstream.operators import logs
from shopstream.schemas import LOG
from shopstream.sources import streams
from tests.conftest import rows

DAY = 24 * 3600 * 1000
NOON = 1704110400000  # 2024-01-01 12:00


def pages(spark, data):
    """(mid, last_page_id, ts, n) rows with a row time."""
    df = spark.createDataFrame(data, "mid string, last_page_id string, ts long, n int")
    return df.withColumn("rt", time_of_ms(F.col("ts")))


def test_repair_is_new(spark):
    df = spark.createDataFrame([
        ("two days", "1", NOON, 1), ("two days", "1", NOON + 1000, 2), ("two days", "1", NOON + DAY, 3),
        ("old first", "0", NOON, 4), ("old first", "1", NOON + 1, 5), ("old first", "1", NOON + DAY, 6),
        ("old later", "1", NOON, 7), ("old later", "0", NOON + 5, 8), ("old later", "1", NOON + 2 * DAY, 9),
        ("same ms", "0", NOON, 10), ("same ms", "1", NOON, 11),
        ("never", "0", NOON, 12), ("none", None, NOON, 13),
    ], "mid string, is_new string, ts long, n int")
    got = dict((n, v) for n, v in rows(logs.repair_is_new(df), "n", "is_new"))
    assert got == {1: "1", 2: "1", 3: "0", 4: "0", 5: "0", 6: "0", 7: "1", 8: "0", 9: "0", 10: "0", 11: "1", 12: "0", 13: None}


def test_bounce_cases(spark):
    data = [
        ("entry entry", None, 0, 1), ("entry entry", None, 9_999, 2), ("entry entry", "home", 10_000, 3),
        ("entry page", None, 0, 4), ("entry page", "home", 9_999, 5),
        ("alone", None, 0, 6),
        ("at limit", None, 0, 7), ("at limit", "home", 10_000, 8),
        ("three", None, 0, 9), ("three", None, 1, 10), ("three", None, 2, 11),
        ("page only", "home", 0, 12),
    ]
    got = [n for n, in rows(logs.bounces(pages(spark, data), "n"), "n")]
    # 2 is followed by a page within the limit
    assert got == [1, 6, 7, 9, 10, 11]


def brute_bounces(data, within):
    out = []
    by_mid = {}
    for r in data:
        by_mid.setdefault(r[0], []).append(r)
    for group in by_mid.values():
        group.sort(key=lambda r: (r[2], r[3]))
        for r, nxt in zip(group, [*group[1:], None]):
            if r[1] is None and not (nxt and nxt[2] - r[2] < within and nxt[1] is not None):
                out.append(r[3])
    return sorted(out)


def random_pages(seed, n=600, span=400_000):
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.34 else f"m{rnd.randrange(12)}", None if rnd.random() < 0.4 else "home", rnd.randrange(span), i)
            for i in range(n)]


@pytest.mark.parametrize("slots", [1, 2, 7, 360])
def test_bounces_do_not_depend_on_slots(spark, slots):
    data = random_pages(slots)
    got = [n for n, in rows(logs.bounces(pages(spark, data), "n", 1000, slots=slots), "n")]
    assert got == brute_bounces(data, 1000)


LINES = [
    json.dumps({"common": {"mid": "m1", "ar": "1", "is_new": "1"}, "page": {"page_id": "home", "during_time": 5},
                "displays": [{"item": "7", "order": 1}, {"item": "8", "order": 2}],
                "actions": [{"action_id": "cart", "ts": 77}], "ts": 50}),
    json.dumps({"common": {"mid": "m2"}, "start": {"entry": "icon"}, "err": {"error_code": 3}, "displays": [{"item": "9"}], "ts": 60}),
    json.dumps({"common": {"mid": "m3"}, "page": {"page_id": "cart", "last_page_id": "home"}, "err": {"error_code": 4}, "ts": 70}),
    '{"common": {"mid": "m4"',
    "",
]


@pytest.fixture()
def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_parse_keeps_good_lines_and_sets_bad_ones_aside(lines):
    assert rows(streams.logs(lines), "common.mid", "ts") == [("m1", 50), ("m2", 60), ("m3", 70)]
    assert rows(streams.dirty(lines)) == [("",), ('{"common": {"mid": "m4"',)]


def test_null_values_read_as_empty(spark):
    df = spark.createDataFrame([(None,), (bytearray(b"x"),)], "value binary")
    assert rows(streams.text_lines(df)) == [("",), ("x",)]


def test_split(lines):
    parsed = streams.logs(lines)
    assert rows(logs.errors(parsed), "common.mid") == [("m2",), ("m3",)]
    assert rows(logs.starts(parsed), "common.mid", "start") == [("m2", '{"entry":"icon"}')]
    assert rows(logs.pages(parsed), "common.mid") == [("m1",), ("m3",)]
    assert "displays" not in logs.pages(parsed).columns
    # a start row goes no further, whatever it holds
    assert rows(logs.displays(parsed), "common.mid", "page_id", "ts", "display.item") == [("m1", "home", 50, "7"), ("m1", "home", 50, "8")]
    assert rows(logs.actions(parsed), "page_id", "ts", "action.action_id") == [("home", 77, "cart")]


def test_route_gives_the_same_rows_in_one_pass(lines):
    parsed = streams.logs(lines)
    routed = logs.route(parsed)
    kinds = {"page": logs.pages, "start": logs.starts, "display": logs.displays, "action": logs.actions, "error": logs.errors}
    for kind, split in kinds.items():
        assert routed.where(F.col("topic") == logs.TOPICS[kind]).count() == split(parsed).count(), kind
    page = routed.where(F.col("topic") == logs.TOPICS["page"]).orderBy("value").first().value
    assert json.loads(page) == {"common": {"mid": "m1", "ar": "1", "is_new": "1"}, "page": {"page_id": "home", "during_time": 5}, "ts": 50}
    display = routed.where(F.col("topic") == logs.TOPICS["display"]).orderBy("value").first().value
    assert json.loads(display) == {
        "display": {"item": "7", "order": "1"}, "common": {"mid": "m1", "ar": "1", "is_new": "1"}, "page_id": "home", "ts": 50}


def test_flatten(lines):
    flat = logs.flatten(logs.pages(streams.logs(lines)))
    assert rows(flat, "mid", "page_id", "last_page_id", "during_time") == [("m1", "home", None, 5), ("m3", "cart", "home", None)]
    assert LOG.names[-1] == "ts"
