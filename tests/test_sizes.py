"""What a task holds is bounded by sizes, whatever the session's number of shuffle partitions."""

import os
import re
import time

from pyspark.sql import functions as F

from shopstream.operators import facts
from shopstream.plans import views
from shopstream.plans.catalog import OPERATORS
from shopstream.plans.warehouse import Warehouse
from shopstream.session import CUT, PART_BYTES, TASK_BYTES, stored_bytes
from shopstream.streaming import live
from shopstream.streaming.live import Live
from tests.conftest import rows

RANDOM = "concat_ws(' ', transform(sequence(1, 40), i -> uuid()))"


def _unset(spark):
    for key in (CUT, *TASK_BYTES):
        spark.conf.unset(key)


def _parts(plan):
    """Number of shuffle partitions before small ones are joined."""
    return max(int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\)", plan))


def test_shuffles_have_more_parts_for_larger_tables(spark, tmp_path):
    _unset(spark)
    spark.range(40_000).select("id", F.expr(RANDOM).alias("text")).write.parquet(f"{tmp_path}/large.parquet")
    size = stored_bytes(spark, str(tmp_path))
    assert size == sum(os.path.getsize(f"{at}/{f}") for at, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet"))
    Warehouse(spark, str(tmp_path))
    large = spark.read.parquet(f"{tmp_path}/large.parquet")
    plan = large.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert _parts(plan) == -(-size // PART_BYTES) > 2
    Warehouse(spark, "/root/testdata/sf0.001")
    plan = large.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert _parts(plan) == 2


def test_sizes_that_the_user_has_set_stay(spark, tmp_path):
    _unset(spark)
    spark.range(1).write.parquet(f"{tmp_path}/small.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    Warehouse(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"
    _unset(spark)


def test_a_table_is_read_once_to_be_dealt(spark, tmp_path, monkeypatch):
    """Every micro-batch holds its own rows, in order, in as many files as its bytes ask for."""
    monkeypatch.setattr(live, "FILE_BYTES", 1 << 19, raising=False)
    texts = spark.range(2_000).select((1_999 - F.col("id")).alias("doc_id"), F.expr(RANDOM).alias("text"))
    texts.union(spark.sql("select cast(null as bigint), 'none'")).write.parquet(f"{tmp_path}/documents.parquet")
    v = Live(spark, str(tmp_path))
    read = []

    def counted(stamp):
        count = spark.sparkContext.accumulator(0)
        read.append(count)

        def seen(x):
            count.add(1)
            return x
        return F.udf(seen, "long")(stamp)

    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    v.deal("documents", table.withColumn("seen", counted(F.col("doc_id"))), F.col("doc_id"))
    assert read[0].value <= 2 * 2_001  # a whole row is made once to be cut, at most once more to be counted
    path = f"{v.base}/dealt-documents"
    files = sorted((os.path.getmtime(f"{path}/{f}"), f) for f in os.listdir(path) if f.endswith(".parquet"))
    assert v.dealt["documents"] > 1 and len(files) == live.BATCHES * v.dealt["documents"]
    spans = []
    for k in range(live.BATCHES):
        names = [f"{path}/{f}" for _, f in files[k * v.dealt["documents"]:(k + 1) * v.dealt["documents"]]]
        spans.append(spark.read.parquet(*names).agg(F.min("doc_id"), F.max("doc_id"), F.count("*"), F.count("doc_id")).first())
    assert [s[0] for s in spans][0] == 0 and spans[-1][1] == 1_999 and sum(s[2] for s in spans) == 2_001
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and [s[2] - s[3] for s in spans] == [1, 0, 0, 0]
    _unset(spark)


def test_paid_details_are_joined_once_for_both_batches(spark, monkeypatch):
    made = []
    wide = Warehouse.wide

    def counted(self):
        count = self.spark.sparkContext.accumulator(0)
        made.append(count)

        def seen(x):
            count.add(1)
            return x
        rows = wide(self)
        return rows.withColumn("id", F.udf(seen, "string")("id"))
    plain = rows(OPERATORS["pay_upsert"](Warehouse(spark, "/root/testdata/sf0.001")))
    monkeypatch.setattr(Warehouse, "wide", counted)
    got = rows(OPERATORS["pay_upsert"](Warehouse(spark, "/root/testdata/sf0.001")))
    monkeypatch.undo()
    w = Warehouse(spark, "/root/testdata/sf0.001")
    once = w.wide().where("type = 'insert'").count()
    assert got == plain and made[0].value <= 1.2 * once
    _unset(spark)


def test_trade_records_are_made_as_they_are_read(spark, tmp_path, monkeypatch):
    """Dealt are rows, not records of maps; each record comes once, in its own micro-batch, also where a cut parts a row's records."""
    monkeypatch.setattr(live, "BATCH_ROWS", 10)
    day = "timestamp'2024-01-01 00:00:00'"
    spark.range(60).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "array('O', 'F', 'P', null)[cast(id % 4 as int)] as o_orderstatus",
        "cast(id as double) as o_totalprice", f"if(id = 3, null, {day} + make_interval(0, 0, 0, 0, 0, id * 4)) as o_orderdate",
        "'1-URGENT' as o_orderpriority").union(spark.sql(f"select 5L, 1L, 'F', 2.0D, {day}, '2-HIGH'")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(100).selectExpr(
        "id % 70 as l_orderkey", "if(id = 9, null, cast(id % 3 as int)) as l_linenumber", "id % 11 as l_partkey", "id % 30 as l_suppkey",
        "cast(id as double) as l_quantity", "cast(id as double) as l_extendedprice", "(id % 10) / 100D as l_discount",
        "(id % 8) / 100D as l_tax", "if(id % 2 = 0, 'R', 'N') as l_returnflag", "if(id % 3 = 0, 'F', 'O') as l_linestatus",
        f"if(id = 69, null, {day} + make_interval(0, 0, 0, id % 9)) as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    v = Live(spark, str(tmp_path))
    columns = ["table", "type", "ts", F.to_json("data").alias("data"), F.to_json("old").alias("old")]
    want = rows(views.trade_feed(v.table("lineitem"), v.table("orders")).select(*columns))
    batches = []
    v.keep(v.trade().select(*columns), lambda batch, n: batches.append(rows(batch)), "records")
    held = spark.read.parquet(f"{v.base}/dealt-trade")
    assert not [c for c, kind in held.dtypes if kind.startswith("map")]
    assert sorted((r for b in batches for r in b), key=str) == sorted(want, key=str) and len(batches) > live.BATCHES
    times = [[int(r[2]) for r in b if r[2] is not None] for b in batches]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:])) and not [r for b in batches[1:] for r in b if r[2] is None]
    assert held.count() > 161  # rows whose records are parted by a cut lie on both sides of it
    some = v.trade("payment_info", "order_info")
    kept = []
    v.keep(some.select(*columns), lambda batch, n: kept.extend(rows(batch)), "some")
    assert sorted(kept, key=str) == sorted((r for r in want if r[0] in ("payment_info", "order_info")), key=str)
    _unset(spark)


def test_a_cut_of_the_trade_feed_reads_its_own_rows_once(spark, monkeypatch):
    """Four cuts meet in a wide row: the dealt rows are scanned once for each, not once for each pair of them."""
    ran, start = [], live.sinks.to_table

    def kept(*args):
        ran.append(start(*args))
        return ran[-1]
    monkeypatch.setattr(live.sinks, "to_table", kept)
    v = Live(spark, "/root/testdata/sf0.001")
    assert v.wide().count() > 0
    dealt = spark.read.parquet(f"{v.base}/dealt-trade").count()
    assert sum(p["numInputRows"] for p in ran[0].recentProgress) <= len(live.WIDE) * dealt
    _unset(spark)


def test_the_keys_of_an_order_are_read_without_a_map(spark):
    w = Warehouse(spark, "/root/testdata/sf0.001")
    rows = views.trade_rows(w.table("lineitem"), w.table("orders"))
    orders = facts.rows_of(views.trade_records(rows, "order_info"), "order_info").select(*facts.fields("id", *facts.ORDER_INFO[1:]))
    assert "map(id" not in orders._jdf.queryExecution().optimizedPlan().toString()
    assert orders.where("id is not null and total_amount is not null and user_id is not null").count() == orders.count() > 0
    _unset(spark)


def test_landed_details_meet_their_orders_a_micro_batch_at_a_time(spark, monkeypatch):
    """A landed table of more rows than a micro-batch is not read in one, whose state would hold them all."""
    ran, start = {}, live.sinks.to_table

    def kept(df, path, *args):
        ran[os.path.basename(path)] = start(df, path, *args)
        return ran[os.path.basename(path)]
    w = Warehouse(spark, "/root/testdata/sf0.001")
    want = rows(w.first_details())
    monkeypatch.setattr(live, "BATCH_ROWS", 2_000)
    monkeypatch.setattr(live.sinks, "to_table", kept)
    v = Live(spark, "/root/testdata/sf0.001")
    got = v.order_facts()
    details = v.first_details().count()
    assert got.count() == len(want) == details > 2_000
    amounts = "sum(cast(order_price as decimal(38,2)))", "count(distinct order_id)", "count(distinct user_id)", "min(rt)", "max(rt)"
    assert rows(got.selectExpr(*amounts)) == rows(w.first_details().selectExpr(*amounts))
    held = [max(s["numRowsTotal"] for s in p["stateOperators"]) for p in ran["order_facts"].recentProgress]
    assert len(held) >= live.BATCHES and max(held) < details
    _unset(spark)


def test_a_landed_table_keeps_step_with_the_trade_topic(spark, monkeypatch):
    """Its micro-batches are cut as those of the topic are, also where one has few rows or none."""
    monkeypatch.setattr(live, "BATCH_ROWS", 4)
    monkeypatch.setattr(live, "FILE_ROWS", 1)
    v = Live(spark, "/root/testdata/sf0.001")
    v.cut_at["trade"] = [10, 20, 30]
    path = f"{v.base}/some"
    some = spark.createDataFrame([(t,) for t in (None, 1, 31, 10, 32, 2, 5, 40, 33)], "t long").select("t", F.timestamp_seconds("t").alias("pt"))
    some.write.parquet(path)
    batches = []
    v.keep(v.follow("some", spark.read.parquet(path), "pt"), lambda batch, n: batches.append([r[0] for r in rows(batch, "t")]), "read")
    assert batches == [[None, 1, 2, 5, 10], [], [], [31, 32, 33, 40]]
    assert v.dealt["landed-some"] > 1
    _unset(spark)


def test_payments_meet_details_of_new_orders_only(spark):
    """No wide row of an order's later records is made to be thrown away."""
    v = Live(spark, "/root/testdata/sf0.001")
    w = Warehouse(spark, "/root/testdata/sf0.001")
    paid = facts.paid_details(w.trade_changes(), facts.order_details(w.wide()), w.dictionary())
    clock = F.col("row_op_ts").isNotNull()  # not compared, it is the time of writing
    want = rows(paid.withColumn("row_op_ts", clock))
    got = rows(v.paid().withColumn("row_op_ts", clock))
    assert got == want and len(got) > 0
    landed = spark.read.parquet(f"{v.base}/details")
    assert "wide" not in v.landed and landed.where("type <> 'insert'").count() == 0
    assert landed.count() == facts.order_details(w.wide()).count()
    _unset(spark)


def test_text_is_dealt_by_its_bytes(spark, tmp_path, monkeypatch):
    """Few rows of long texts are many words: the state of a micro-batch is bounded by what is stored, not by rows alone."""
    monkeypatch.setattr(live, "BATCH_BYTES", 1 << 18, raising=False)
    texts = spark.range(1_000).select(F.col("id").alias("doc_id"), F.expr(RANDOM).alias("text"))
    texts.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    v = Live(spark, str(tmp_path))
    batches = []
    v.keep(v.stream("documents"), lambda batch, n: batches.append([r[0] for r in rows(batch, "doc_id")]), "texts")
    assert len(batches) > live.BATCHES and sorted(x for b in batches for x in b) == list(range(1_000))
    assert all(a[-1] < b[0] for a, b in zip(batches, batches[1:])) and max(map(len, batches)) < 1_000 / live.BATCHES
    _unset(spark)


def test_a_job_keeps_little_on_disk(spark, monkeypatch):
    """Copies that were dealt are gone, and old state is not kept."""
    ran, start = [], live.sinks.to_table

    def kept(*args):
        ran.append({key: spark.conf.get(key) for key in live.KEPT})
        return start(*args)
    monkeypatch.setattr(live.sinks, "to_table", kept)
    v = Live(spark, "/root/testdata/sf0.001")
    assert v.newest_details().count() > 0
    assert not [f for f in os.listdir(v.base) if f.startswith(("cut-", "trade-rows"))]
    assert ran and all(seen == live.KEPT for seen in ran)
    assert all(spark.conf.get(key, None) is None for key in live.KEPT)
    _unset(spark)


def test_shuffles_of_a_batch_go_when_it_is_written(spark):
    """Two batches and the joins before them: the shuffles of one of them are on disk at a time."""
    def shuffles():
        return disk.getAllFiles().mkString("\n").count(".data")

    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    spark.sparkContext._jvm.System.gc()
    time.sleep(3)
    before, base = shuffles(), spark.conf.get("spark.checkpoint.dir")
    known = set(os.listdir(base))
    OPERATORS["pay_upsert"](Warehouse(spark, "/root/testdata/sf0.001"))
    end = time.time() + 10
    while shuffles() > before and time.time() < end:
        time.sleep(0.5)
    assert shuffles() <= before
    assert not [f for f in set(os.listdir(base)) - known if f.startswith("paid-details")]
    _unset(spark)
