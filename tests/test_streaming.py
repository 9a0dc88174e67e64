"""A stream fed file by file must give what the same rows give as a table."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shopstream.functions import sketches
from shopstream.functions.times import time_of_ms
from shopstream.operators import facts, flags, logs, windows
from shopstream.plans import reports, views
from shopstream.plans.warehouse import Warehouse
from shopstream.schemas import CHANGE
from shopstream.session import shared_dir
from shopstream.sources import sinks, streams
from shopstream.sources.keyed import KeyedTable
from shopstream.streaming import state
from shopstream.streaming.live import Live
from tests.conftest import at, rows
from tests.test_facts import T, change

START = at("2024-01-01T23:58:00")
END = at("2200-01-01")


class Feed:
    """A folder that gets its files one after another, read as a stream one file per batch."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.path, self.base, self.files = shared_dir(spark, "feed"), shared_dir(spark, "job"), 0

    def put(self, *batches):
        for batch in batches:
            self.spark.createDataFrame(list(batch), self.schema).coalesce(1).write.mode("append").parquet(self.path)
        return self

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        return streams.file_table(self.spark, self.path, schema, files_per_batch=1)

    def run(self, df, name="out"):
        path = f"{self.base}/{name}"
        sinks.to_table(df, path, f"{self.base}/checkpoint-{name}").awaitTermination()
        return self.spark.read.schema(df.schema).parquet(path)

    def run_firsts(self, df, name="firsts"):
        path = f"{self.base}/{name}"
        query = sinks.to_batches(df, path, f"{self.base}/checkpoint-{name}")
        query.awaitTermination()
        self.progress = query.recentProgress
        return self.spark.read.schema(df.schema).parquet(f"{path}/batch_id=*")

    def follow(self, df, name="firsts", files=None):
        return streams.file_table(self.spark, f"{self.base}/{name}/batch_id=*", df.schema, files_per_batch=files)


def cut(data, n):
    size = -(-len(data) // n)
    return [data[i:i + size] for i in range(0, len(data), size)]


PAGES = "mid string, is_new string, last_page_id string, ts long, n int"


def page_rows(seed, n=300, jitter=0):
    """Visits of a hot and some other visitors around midnight, in time order but for the jitter."""
    rnd = random.Random(seed)
    base = int(START.timestamp() * 1000)
    out = []
    for i in range(n):
        ts = base + i * 1000 + rnd.randrange(900)
        mid = "hot" if rnd.random() < 0.34 else f"m{rnd.randrange(9)}"
        out.append((mid, rnd.choice(["0", "1"]), rnd.choice([None, "home"]), ts, i))
    return sorted(out, key=lambda r: r[3] + (rnd.randrange(jitter) if jitter else 0))


END_ROW = ("end", "0", None, int(END.timestamp() * 1000), -1)


def timed(df):
    return df.withColumn("rt", time_of_ms(F.col("ts")))


def live(df):
    return df.where("n >= 0")


@pytest.fixture()
def page_feed(spark):
    data = page_rows(5)
    return data, Feed(spark, PAGES).put(*cut(data, 3), [END_ROW]), timed(spark.createDataFrame(data, PAGES))


def test_first_rows_and_their_windows(page_feed):
    _, feed, table = page_feed
    firsts = feed.run_firsts(state.first_rows(timed(feed.stream()), ["mid"], ["rt", "n"]))
    flagged = feed.run_firsts(state.with_history(feed.follow(firsts), "mid"), "flags")
    want = flags.flag_rows(table, "mid", "rt", "n").where("is_daily_first")
    assert rows(live(flagged), "n", "is_first_ever") == rows(want, "n", "is_first_ever")
    counts = windows.payment_window(feed.follow(flagged, "flags"))
    assert rows(feed.run(counts, "windows")) == rows(windows.payment_window(want))


@pytest.mark.parametrize("seed", [1, 7])
def test_flags_do_not_depend_on_the_order_of_rows(spark, seed):
    day, base = 24 * 3600 * 1000, int(START.timestamp() * 1000)
    data = [("hot", "0", None, base + d * day + i, 100 * d + i) for d in (3, 5, 1, 9) for i in range(12)]
    shuffled = data[:]
    random.Random(seed).shuffle(shuffled)
    for n, batches in enumerate(([shuffled], [data[i:i + 12] for i in range(0, 48, 12)])):
        feed = Feed(spark, PAGES).put(*batches)
        firsts = feed.run_firsts(state.first_rows(timed(feed.stream()), ["mid"], ["rt", "n"], delay="30 days"))
        assert sorted(r.n for r in firsts.collect()) == [100, 300, 500, 900]
        got = feed.run_firsts(state.with_history(feed.follow(firsts, files=n or None), "mid", back_days=4, delay="30 days"), "flags")
        # in one batch days are in order; else the first to arrive is first, and a late day has none before it
        assert rows(got, "n", "is_first_ever", "is_back") == [
            (100, True, False), (300, n == 1, False), (500, False, False), (900, False, True)]


def test_rows_of_no_key_come_once_and_late_days_are_left_out(spark):
    day, base = 24 * 3600 * 1000, int(START.timestamp() * 1000)
    feed = Feed(spark, PAGES).put(
        [(None, "0", None, base, 1), (None, "0", None, base + 1, 2), ("a", "0", None, None, 3)], [("a", "0", None, base + 9 * day, 4)],
        [("b", "0", None, base + 9 * day, 8)], [("a", "0", None, base, 5), ("a", "0", None, base + 9 * day - 1, 6), (None, "0", None, base + 9 * day, 7)])
    got = feed.run_firsts(state.first_rows(timed(feed.stream()), ["mid"], ["rt", "n"], delay="2 seconds"))
    assert sorted(r.n for r in got.collect()) == [1, 4, 7, 8]


def test_repair_of_flags_batch_by_batch(spark, page_feed, tmp_path):
    data, feed, table = page_feed
    v = Live(spark, str(tmp_path))
    v.pages = lambda: timed(feed.stream()).where("n >= 0")
    got = v.repaired()
    assert got.count() == len(data)
    assert rows(got, "n", "is_new") == rows(logs.repair_is_new(table), "n", "is_new")


def test_no_fact_is_made_of_nulls(spark, tmp_path):
    """Events without a type or a user are no registration, cart or login."""
    real = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(40)
    odd = real.withColumn("event_type", F.lit(None).cast("string")).unionByName(
        real.withColumns({"event_type": F.lit("signup"), "user_id": F.lit(None).cast("long")}))
    odd.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    v, w = Live(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    v.stream = lambda name: views.instants(streams.file_table(spark, f"{tmp_path}/{name}.parquet", real.schema))
    assert rows(v.carts()) == rows(w.carts()) == []
    assert rows(v.logins()) == rows(w.logins())
    assert rows(v.registers()) == rows(w.registers())


def test_days_are_remembered_for_so_long(spark):
    """"Ever" is within the days remembered, and state holds no more than three times as many."""
    day, base, memory = 24 * 3600 * 1000, int(START.timestamp() * 1000), 4
    days = {"a": [0, 3, 8, 12, 13, 30], "b": list(range(0, 32, 2)), "c": [1, 20]}
    batches = [[(k, "0", None, base + d * day, 100 * "abc".index(k) + d) for k in days if d in days[k]] for d in range(32)]
    feed = Feed(spark, PAGES).put(*(b or [("x", "0", None, base + d * day, -1 - d)] for d, b in enumerate(batches)))
    pages = timed(feed.stream())
    got = feed.run_firsts(state.with_history(pages, "mid", memory_days=memory, back_days=3), "flags").where("n >= 0")
    want = []
    for k, seen in days.items():
        for d in seen:
            last = max((x for x in seen if d - memory <= x < d), default=None)
            want.append((100 * "abc".index(k) + d, last is None, last is not None and d - last >= 3))
    assert rows(got, "n", "is_first_ever", "is_back") == sorted(want)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in feed.progress if p["stateOperators"]]
    assert len(held) >= 30 and max(held[20:]) <= 4 * 3  # keys times windows that overlap the days kept
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in feed.progress) > 0


def test_state_of_past_days_is_dropped(spark):
    day, base = 24 * 3600 * 1000, int(START.timestamp() * 1000)
    feed = Feed(spark, PAGES).put(*([(f"m{k}", "0", None, base + d * day + k, 10 * d + k) for k in range(5)] for d in range(31)))
    got = feed.run_firsts(state.first_rows(timed(feed.stream()), ["mid"], ["rt", "n"]))
    assert got.count() == 155
    held = [p["stateOperators"][0]["numRowsTotal"] for p in feed.progress if p["stateOperators"]]
    assert len(held) >= 31 and max(held) <= 5 * 3  # three days at the most


def test_a_busy_key_is_combined_before_the_shuffle(spark, page_feed):
    _, feed, _ = page_feed
    query = sinks.to_batches(state.first_rows(timed(feed.stream()), ["mid"], ["rt", "n"]), f"{feed.base}/plan", f"{feed.base}/checkpoint-plan")
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "partial_min_by" in plan and plan.index("partial_min_by") > plan.index("Exchange hashpartitioning")
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("seed", [6, 7])
def test_bounces_in_any_order_within_the_delay(spark, seed):
    data = page_rows(seed, jitter=3000)
    feed = Feed(spark, PAGES).put(*cut(data, 4), [END_ROW])
    got = feed.run(state.bounces(timed(feed.stream()), "n", within_ms=5000, delay="10 seconds"))
    want = logs.bounces(timed(spark.createDataFrame(data, PAGES)), "n", within_ms=5000)
    assert rows(live(got), "n") == rows(want, "n")


def test_late_rows_are_left_out_of_closed_windows(spark):
    base = 1704067200000
    feed = Feed(spark, PAGES).put(
        [("a", "0", None, base, 1)], [("a", "0", None, base + 13_000, 2)], [("a", "0", None, base + 13_001, 5)],
        [("a", "0", None, base + 9_000, 3)], [("a", "0", None, base + 12_000, 4)], [END_ROW])
    got = feed.run(windows.register_window(timed(feed.stream())))
    # row 3 comes after the watermark passed its window, row 4 in time
    assert rows(got, "stt", "register_ct") == [("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:10", 3)]


def test_restart_gives_no_duplicates(spark):
    data = page_rows(8)
    parts = cut(data, 3)
    feed = Feed(spark, PAGES).put(parts[0])

    def run():
        firsts = feed.run_firsts(state.first_rows(timed(feed.stream()), ["mid"], ["rt", "n"]))
        flagged = feed.run_firsts(state.with_history(feed.follow(firsts), "mid"), "flags")
        return feed.run(windows.payment_window(feed.follow(flagged, "flags")))

    for batch in [*parts[1:], [END_ROW]]:
        run()
        feed.put(batch)
    run()
    firsts = flags.with_first_ever(flags.daily_first(timed(spark.createDataFrame(data, PAGES)), ["mid"], "rt"), "mid")
    assert rows(run()) == rows(windows.payment_window(firsts))


def test_first_arrivals_by_id(spark):
    feed = Feed(spark, "id string, t timestamp, v int").put(
        [("a", START, 1), ("b", START, 2)], [("a", START + timedelta(seconds=2), 3)], [("z", START + timedelta(seconds=60), 4)],
        [("z", START + timedelta(seconds=61), 6)], [("a", START + timedelta(seconds=61), 5)])
    got = feed.run(state.first_arrivals(feed.stream(), ["id"], "t", "5 seconds"))
    # within the horizon a repeat is dropped, later it counts again
    assert rows(got, "id", "v") == [("a", 1), ("a", 5), ("b", 2), ("z", 4)]


def test_last_versions(spark):
    def s(x):
        return START + timedelta(seconds=x)

    feed = Feed(spark, "id string, row_op_ts timestamp, v int").put(
        [("a", s(0), 1), ("a", s(1), 2)], [("a", s(3), 3), ("b", s(2.5), 9)], [("b", s(2), 8)], [("c", s(90), 7)], [("end", END, 0)])
    got = feed.run(state.last_versions(feed.stream(), ["id"], "row_op_ts"))
    assert rows(got, "id", "v") == [("a", 3), ("b", 9), ("c", 7)]


def test_order_window_of_a_stream(spark):
    schema = "n int, user_id string, rt timestamp, sku_num int, order_price double, split_activity_amount double, split_coupon_amount double"
    rnd = random.Random(3)
    data = [(i, f"u{rnd.randrange(12)}", START + timedelta(seconds=i), rnd.randrange(1, 4), rnd.randrange(1, 9999) / 100,
             rnd.choice([None, 0.5]), rnd.choice([None, 0.25])) for i in range(200)]
    feed = Feed(spark, schema).put(*cut(data, 3), [(-1, "end", END, 1, 1.0, None, None)])
    # the two inputs move on at different speed: one file per batch, and all at once
    firsts = feed.run_firsts(state.first_rows(feed.stream(), ["user_id"], ["rt", "n"]))
    flagged = feed.run_firsts(state.with_history(feed.follow(firsts), "user_id"), "flags")
    got = feed.run(windows.order_window_from_firsts(feed.stream(), feed.follow(flagged, "flags")))
    assert rows(got) == rows(windows.order_window(spark.createDataFrame(data, schema)))


def test_fact_joins_of_streams(spark):
    dic = spark.createDataFrame([("1", "one"), ("3", "three")], "dic_code string, dic_name string")

    def ts(seconds):
        return str(int(START.timestamp()) + seconds)

    def detail(i, order, seconds):
        return change("order_detail", "insert", {"id": i, "order_id": order, "source_type": 1, "create_time": T}, ts=ts(seconds))

    batches = [
        [detail(1, 10, 0), change("order_info", "insert", {"id": 10, "user_id": 5, "order_status": 1001}, ts=ts(1))],
        [change("order_detail_activity", "insert", {"id": 50, "order_detail_id": 1, "activity_id": 6}, ts=ts(2)), detail(2, 11, 3)],
        [change("order_info", "insert", {"id": 11, "user_id": 6, "order_status": 1001}, ts=ts(4)),
         change("order_info", "update", {"id": 10, "user_id": 5, "order_status": 1003}, {"order_status": "1001"}, ts=ts(20)),
         change("payment_info", "update", {"order_id": 11, "payment_type": 3, "payment_status": 1602, "callback_time": T}, ts=ts(30))],
        [change("order_info", "insert", {"id": -1}, ts="7258118400")],
    ]
    feed = Feed(spark, CHANGE).put(*batches)
    table = spark.createDataFrame([r for b in batches for r in b], CHANGE)
    columns = ["id", "type", "user_id", "activity_id", "coupon_id", "source_type_name"]
    want = facts.order_wide(table, dic)
    # order_detail_coupon never gets a record
    with streams.one_topic(spark):
        got = feed.run(facts.order_wide(feed.stream(), dic, within="15 minutes"))
        near = feed.run(facts.order_wide(feed.stream(), dic, within="5 seconds"), "near")
    assert rows(got, *columns) == rows(want, *columns) == [
        ("1", "insert", "5", "6", None, "one"), ("1", "update", "5", "6", None, "one"), ("2", "insert", "6", None, None, "one")]
    # outside the range two rows do not meet
    assert rows(near, "id", "type") == [("1", "insert"), ("2", "insert")]


def test_each_batch_reads_the_config_anew(spark):
    feed = Feed(spark, "id string, name string, ts long").put([("1", "a", 1)], [("1", "b", 2), ("2", "c", 2)])
    path, seen = shared_dir(spark, "upserts"), []
    write = sinks.upsert_batches(path, ["id"], ["ts"])

    def each(batch, batch_id):
        seen.append(batch_id)
        write(batch, batch_id)

    sinks.for_each_batch(feed.stream(), each, f"{feed.base}/checkpoint").awaitTermination()
    assert seen == [0, 1]
    assert rows(sinks.read_upserts(spark, path, ["id"], ["ts"]), "id", "name") == [("1", "b"), ("2", "c")]


def test_payment_and_refund_joins_of_streams(spark):
    dic = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", "three")], "dic_code string, dic_name string")
    start = int(START.timestamp())

    def record(seconds, table, kind, old=None, **data):
        return change(table, kind, data, old, ts=str(start + seconds))

    batches = [
        [record(0, "order_detail", "insert", id=1, order_id=10, sku_id=7, source_type=1),
         record(1, "order_info", "insert", id=10, user_id=5, province_id=3, order_status=1001)],
        [record(30, "payment_info", "update", order_id=10, payment_type=3, payment_status=1602, callback_time=T),
         record(31, "payment_info", "update", order_id=10, payment_type=99, payment_status=1602, callback_time=T)],
        [record(60, "order_refund_info", "insert", id=70, order_id=10, sku_id=7, refund_type=1, refund_reason_type=2, refund_num=1, create_time=T),
         record(61, "order_info", "update", {"order_status": "1002"}, id=10, user_id=5, province_id=3, order_status=1005)],
        [record(90, "order_info", "update", {"order_status": "1005"}, id=10, user_id=5, province_id=3, order_status=1006),
         record(91, "refund_payment", "insert", id=80, order_id=10, sku_id=7, payment_type=3, callback_time=T, total_amount="5.00")],
        [record(10 ** 9, "order_info", "insert", id=-1)],
    ]
    feed = Feed(spark, CHANGE).put(*batches)
    table = spark.createDataFrame([r for b in batches for r in b], CHANGE)

    def jobs(changes, within=None):
        details = facts.order_details(facts.order_wide(changes, dic, within=within))
        yield "paid", facts.paid_details(changes, details, dic, within=within), ["order_detail_id", "payment_type_name"]
        yield "refunds", facts.refunds(changes, dic, within=within), ["id", "province_id", "refund_type_name"]
        yield "refunds_paid", facts.refunds_paid(changes, dic, within=within), ["id", "user_id", "refund_num"]

    with streams.one_topic(spark):
        for (name, stream, columns), (_, want, _) in zip(jobs(feed.stream(), "15 minutes"), jobs(table)):
            got = rows(feed.run(stream, name), *columns)
            assert got == rows(want, *columns) and len(got) == 1, name


RULE_CHANGES = "after struct<source_table:string,sink_table:string,sink_columns:string,sink_pk:string,sink_extend:string>, ts_ms long"


def test_a_rule_and_a_column_added_between_batches_show_up(spark, tmp_path):
    v = Live(spark, str(tmp_path))
    rules = Feed(spark, RULE_CHANGES).put([(("sku", "dim_sku", "id,name", None, None), 1), (None, 2)])
    changes = Feed(spark, CHANGE).put([
        change("sku", "insert", {"id": 1, "name": "a", "color": "red"}, ts="1"), change("shop", "insert", {"key": 7, "city": "x"}, ts="1")])
    table = v.rules(rules.stream())
    first = v.dimensions_of(changes.stream(), table)
    assert set(first) == {"dim_sku"} and rows(first["dim_sku"]) == [("1", "a")]
    rules.put([(("sku", "dim_sku", "id,name,color", None, None), 5)],
              [(("shop", "dim_shop", "key,city", "key", None), 6), (("sku", "dim_sku", "id", None, None), 3)])
    v.rules(rules.stream())
    changes.put([change("sku", "insert", {"id": 2, "name": "b", "color": "blue"}, ts="2"), change("shop", "update", {"key": 8, "city": "y"}, ts="2")],
                [change("sku", "update", {"id": 1, "name": "c", "color": "green"}, ts="3")])
    got = v.dimensions_of(changes.stream(), table)
    # rules of a later time count whatever their order; rows of a rule that was not there yet are not gone back for
    assert rows(got["dim_shop"]) == [("8", "y")]
    assert rows(got["dim_sku"], "id", "name", "color") == [("1", "c", "green"), ("2", "b", "blue")]


def test_a_batch_tried_again_takes_the_rules_of_its_first_try(spark, tmp_path):
    v = Live(spark, str(tmp_path))
    rules = Feed(spark, RULE_CHANGES).put([(("sku", "dim_sku", "id", None, None), 1)])
    table = v.rules(rules.stream())
    seen = rows(table.read(version=table.version_of("dims", 0)), "sink_columns")
    rules.put([(("sku", "dim_sku", "id,name", None, None), 2)])
    v.rules(rules.stream())
    assert rows(table.read(version=table.version_of("dims", 0)), "sink_columns") == seen == [("id",)]
    assert rows(table.read(version=table.version_of("dims", 1)), "sink_columns") == [("id,name",)]


def test_an_update_of_a_dimension_changes_later_rows_only(spark, tmp_path):
    v = Live(spark, str(tmp_path))
    dim = KeyedTable(spark, f"{v.base}/dims/d", ["id"], ["ts"], buckets=2)

    def update(batch_id, *data):
        dim.write(spark.createDataFrame(list(data), "id string, name string, ts long"), batch_id)

    update(0, ("1", "red", 1), ("2", "blue", 1))
    feed = Feed(spark, "n int, sku_id string").put([(1, "1"), (2, " 2 "), (3, "9")], [(4, "1")])
    v.enriched(feed.stream(), dim, "sku_id", {"name": "name"}, "named")
    update(1, ("1", "green", 2), ("9", "new", 2))
    feed.put([(5, "1"), (6, "9"), (7, None)])
    got = v.enriched(feed.stream(), dim, "sku_id", {"name": "name"}, "named")
    assert rows(got, "n", "name") == [(1, "red"), (2, "blue"), (3, None), (4, "red"), (5, "green"), (6, "new"), (7, None)]
    # the batch of the first rows, tried again now, sees what it saw then
    assert rows(dim.read(version=dim.version_of("named", 0)), "id", "name") == [("1", "red"), ("2", "blue")]


def test_sketches_of_a_stream_merge(spark):
    data = [(START + timedelta(seconds=i % 50), "ab"[i % 2], f"u{i % 900}") for i in range(3000)]
    schema = "rt timestamp, k string, uid string"
    feed = Feed(spark, schema).put(data, [(END, "end", "end")])
    got = feed.run(windows.sketch_window(feed.stream(), ["k"], "uid"))
    total = got.agg(sketches.estimate(sketches.merged("uid_sketch")).alias("n")).first().n
    per = rows(got.groupBy("k").agg(sketches.estimate(sketches.merged("uid_sketch")).alias("n")), "k", "n")
    assert got.count() == 10 and abs(total - 900) <= 18 and all(abs(n - 450) <= 9 for _, n in per)


def test_summary_table_of_a_stream(spark, page_feed):
    data, feed, table = page_feed
    keys = ["vc", "ch", "ar"]
    pages = timed(feed.stream()).withColumns({k: F.lit(k) for k in keys}).withColumn("during_time", F.lit(1).cast("long"))
    none = pages.where("n < -9")
    path = shared_dir(spark, "dws")
    job = windows.traffic_window(pages, none, none, "1 minute")
    with streams.one_topic(spark):
        sinks.to_summary(job, path, f"{feed.base}/checkpoint-dws").awaitTermination()
    got = spark.read.parquet(path)
    assert {"dt", "ts", "batch_id"} < set(got.columns) and got.agg(F.sum("pv_ct")).first()[0] == len(data)
    # a batch tried again after a crash replaces itself, day by day
    last = got.agg(F.max("batch_id")).first()[0]
    batch = got.where(F.col("batch_id") == last).drop("batch_id")
    again = spark.createDataFrame(batch.collect(), batch.schema)
    before = rows(got.drop("ts"))
    sinks.write_summary_batch(again, path, last)
    after = spark.read.parquet(path)
    assert rows(after.drop("ts")) == before
    report = reports.channel_visitors(after.drop("ts", "batch_id"), "2024-01-02")
    assert "PartitionFilters: [isnotnull(dt" in report._jdf.queryExecution().executedPlan().toString()
    assert rows(report, "dt", "ch")[0][1] == "ch" and report.count() == 1


def test_streams_have_no_python(spark, monkeypatch):
    """Every plan of the flag and bounce jobs stays on the JVM."""
    plans = []

    def watched(start):
        def run(df, *args, **kwargs):
            plans.append(df._jdf.queryExecution().analyzed().toString())
            return start(df, *args, **kwargs)
        return run

    for name in ("to_table", "to_batches", "to_summary"):
        monkeypatch.setattr(sinks, name, watched(getattr(sinks, name)))
    v = Live(spark, "/root/testdata/sf0.001")
    v.traffic()
    v.logins()
    assert len(plans) >= 6 and not any("Python" in p or "Pandas" in p or "Arrow" in p for p in plans)
