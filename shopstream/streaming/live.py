"""The jobs as streams over a folder of tables.

Each job reads its source as a stream, keeps its place in a checkpoint and
appends to a table; a job that needs another's rows reads that table. All
folders lie below the shared folder of the session. Jobs run over what is
there and stop; with a trigger interval they would go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.functions.keywords import words
from shopstream.functions.times import parse_time
from shopstream.operators import dims, facts, logs, windows
from shopstream.plans import views
from shopstream.plans.warehouse import BACK_DAYS, BOUNCE_MS, DAY, HOUR
from shopstream.schemas import CONFIG, CONFIG_CHANGE
from shopstream.session import FREED, remove, setting, settings, shared_dir, sized_shuffles, stored_bytes
from shopstream.sources import sinks, streams
from shopstream.sources.keyed import KeyedTable
from shopstream.streaming import state

# A window closes when the watermark passes it. So that a finished source gives
# all its windows, its facts are followed by one row of this time and nulls; the
# row's own window stays open. No fact is ever made from it.
END = "2200-01-01 00:00:00"

# A session of a visitor is looked at in slots of 10 days.
STREAM_SLOTS = 40

# A table is replayed in this many micro-batches at least, in order of its time.
BATCHES, BATCH_ROWS, BATCH_BYTES, FILE_ROWS, FILE_BYTES = 4, 4_000_000, 16 << 20, 200_000, 8 << 20
# What a job leaves on disk, unless the user has set otherwise: its state is packed, of past micro-batches it keeps what
# it takes to go back by two (Spark's own number is 100), and a shuffle goes with the micro-batch that made it.
KEPT = {
    "spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s", "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.parquet.compression.codec": "zstd", **FREED,
}
# The tables whose records meet in a wide row.
WIDE = ["order_detail", "order_detail_activity", "order_detail_coupon", "order_info"]
TIMES = {"events": "ts", "lineitem": "l_shipdate", "orders": "o_orderdate", "documents": "doc_id"}


def part_of(stamp: Column, cuts: list[int], first: int = 0) -> Column:
    """The number of ``cuts``, in order, that a time is past, by halving; none if it is null."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return F.when(stamp > cuts[half], part_of(stamp, cuts[half + 1:], first + half + 1)).otherwise(part_of(stamp, cuts[:half], first))


class Live:
    """``partitions`` is the number of parts the state of a job is cut into for
    the life of its checkpoint; by default one per core of the cluster."""

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: int | None = None):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.partitions = partitions or spark.sparkContext.defaultParallelism
        self.spark = spark
        self.sf_dir = sf_dir
        sized_shuffles(spark, sf_dir)
        self.base = shared_dir(spark, "live")
        self.dealt: dict[str, int] = {}
        self.cut_at: dict[str, list[int]] = {}
        self.landed: dict[str, DataFrame] = {}
        self.closing: list[tuple[DataFrame, str]] = []

    def stream(self, name: str) -> DataFrame:
        """A table as a stream. A table with a time is dealt into micro-batches by it."""
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in TIMES:
            rows = streams.file_table(self.spark, self.sf_dir, table.schema, glob=f"{name}.parquet")
        else:
            time = F.col(TIMES[name])
            rows = self.deal(name, table, time if name == "documents" else F.unix_micros(time.cast("timestamp")))
        return views.instants(rows)

    def trade(self, *tables: str) -> DataFrame:
        """The change records of orders and their lines as one topic, in order of time; only those of the tables named, if any.

        Rows are dealt and records made from them as they are read, so a job
        reads no columns and makes no maps that it has no use for.
        """
        return views.trade_records(self.trade_rows(), *tables)

    def cuts(self, *tables: str) -> dict[str, DataFrame]:
        """:meth:`trade` cut by source table.

        Spark still scans the branches of a stream that a filter leaves
        nothing of, so of a union every cut would read the rows of all tables.
        """
        rows = self.trade_rows()
        return {name: views.trade_records(rows, name) for name in tables}

    def trade_rows(self) -> DataFrame:
        """The rows that :meth:`trade` makes its records from."""
        if "trade" not in self.dealt:
            path = f"{self.base}/trade-rows"
            with settings(self.spark, FREED):
                views.trade_rows(self.table("lineitem"), self.table("orders")).write.parquet(path)
            self.feed = self.spark.read.parquet(path)
            self.deal("trade", self.feed, F.col("_made"), views.FEED_LAST)
            remove(self.spark, path)
        return self.deal("trade", self.feed, F.col("_made"), views.FEED_LAST)

    def deal(self, name: str, table: DataFrame, stamp: Column, spread: int | None = None, cuts: list[int] | None = None) -> DataFrame:
        """A table in order of ``stamp`` as a stream; null times come with the first rows.

        It is cut into BATCHES micro-batches, or as many as it takes for
        BATCH_ROWS rows and BATCH_BYTES stored bytes each, and every one is written as files of FILE_ROWS
        or FILE_BYTES, whichever are more. The table is read once to be cut;
        a micro-batch is then written from its own rows only. ``cuts`` are
        those of another table, whose micro-batches it is to keep step with. With ``spread``
        a row's records come up to so much later: it is in every micro-batch
        that one of them may be of, with the slice of time that this one is of
        (see :func:`shopstream.plans.views.in_slice`).
        """
        path = f"{self.base}/dealt-{name}"
        schema = table.schema
        if spread is not None:
            schema = T.StructType([*schema.fields, *(T.StructField(c, T.LongType()) for c in (views.AFTER, views.UPTO))])
        if name not in self.dealt:
            with settings(self.spark, FREED):
                self.dealt[name] = self.write_dealt(name, table, stamp, path, schema, spread, cuts)
        return streams.file_table(self.spark, path, schema, files_per_batch=self.dealt[name])

    def write_dealt(
        self, name: str, table: DataFrame, stamp: Column, path: str, schema: T.StructType, spread: int | None, cuts: list[int] | None,
    ) -> int:
        """Write the micro-batches of :meth:`deal` one after the other, and give the number of files of each."""
        rows = table.count()
        if cuts is None:
            parts = max(BATCHES, ceil(rows / BATCH_ROWS), ceil(sum(map(self.bytes_of, table.inputFiles())) / BATCH_BYTES))
            cuts = table.agg(F.percentile_approx(stamp, [k / parts for k in range(1, parts)], 100 * parts)).first()[0] or []
            cuts = sorted(set(cuts))
        parts = len(cuts) + 1
        self.cut_at[name] = cuts
        cut = f"{self.base}/cut-{name}"
        if spread is None:
            dealt = table.withColumn("_part", part_of(stamp, cuts))
        else:
            ends = F.array(*(F.lit(c).cast("long") for c in [None, *cuts, None]))
            dealt = table.withColumn("_part", F.explode(F.sequence(part_of(stamp, cuts), part_of(stamp + spread, cuts)))).withColumns({
                views.AFTER: F.get(ends, F.col("_part")), views.UPTO: F.get(ends, F.col("_part") + 1)})
        dealt.write.partitionBy("_part").parquet(cut)
        files = max(1, ceil(rows / parts / FILE_ROWS), ceil(stored_bytes(self.spark, cut) / parts / FILE_BYTES))
        staged = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_part", T.IntegerType())])).parquet(cut)
        for k in range(parts):
            some = staged.where(F.col("_part") == k).drop("_part")
            (some.repartition(files) if files > 1 else some.coalesce(1)).write.mode("append").parquet(path)
            # a micro-batch of few rows, or none, has empty files, so that each takes its own
            for _ in range((k + 1) * files - len(self.spark.read.schema(schema).parquet(path).inputFiles())):
                some.limit(0).coalesce(1).write.mode("append").parquet(path)
            remove(self.spark, f"{cut}/_part={k}")
        remove(self.spark, cut)
        return files

    def bytes_of(self, file: str) -> int:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(file))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(where).getLen()

    def ended(self, df: DataFrame, name: str, time: str = "rt", ms: str | None = None, **others: Column) -> DataFrame:
        """Facts followed by their closing row, which :meth:`land` sends after everything else.

        ``ms`` names a column that holds the time in milliseconds as well;
        ``others`` are columns that the closing row needs to get to its watermark.
        """
        path = f"{self.base}/end-{name}"
        end = F.lit(END).cast("timestamp")
        values = {time: end} | ({ms: F.unix_millis(end)} if ms else {}) | others
        row = self.spark.range(1).select(*(
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema))
        row.limit(0).write.parquet(path)
        self.closing.append((row, path))
        return df.unionByName(streams.file_table(self.spark, path, df.schema))

    @contextmanager
    def running(self) -> Iterator[None]:
        """The settings of a job."""
        with settings(self.spark, KEPT), setting(self.spark, "spark.sql.shuffle.partitions", str(self.partitions)):
            yield

    @contextmanager
    def more_to_come(self, closing: list) -> Iterator[None]:
        """No micro-batch without rows only to drop state, if the closing row comes at once and does it as well."""
        if not closing:
            yield
            return
        with settings(self.spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
            yield

    def land(self, df: DataFrame, name: str) -> DataFrame:
        """Run a job into a table, end its sources, let it run on, and return the table."""
        path, checkpoint = f"{self.base}/{name}", f"{self.base}/checkpoint-{name}"
        closing, self.closing = self.closing, []
        with self.running():
            with self.more_to_come(closing):
                sinks.to_table(df, path, checkpoint).awaitTermination()
            for row, end in closing:
                row.write.mode("append").parquet(end)
            if closing:
                sinks.to_table(df, path, checkpoint).awaitTermination()
        return self.spark.read.schema(df.schema).parquet(path)

    def land_summary(self, df: DataFrame, name: str) -> DataFrame:
        """:meth:`land` into a summary table: by day, with write time and batch number, which readers don't see."""
        path, checkpoint = f"{self.base}/{name}", f"{self.base}/checkpoint-{name}"
        closing, self.closing = self.closing, []
        with self.running():
            with self.more_to_come(closing):
                sinks.to_summary(df, path, checkpoint).awaitTermination()
            for row, end in closing:
                row.write.mode("append").parquet(end)
            if closing:
                sinks.to_summary(df, path, checkpoint).awaitTermination()
        return self.spark.read.parquet(path).drop("ts", sinks.BATCH)

    def land_firsts(self, df: DataFrame, name: str) -> DataFrame:
        """Run a job in update mode into a table of a folder a micro-batch, and return the table."""
        path, checkpoint = f"{self.base}/{name}", f"{self.base}/checkpoint-{name}"
        with self.running():
            sinks.to_batches(df, path, checkpoint).awaitTermination()
        return self.spark.read.schema(df.schema).parquet(f"{path}/{sinks.BATCH}=*")

    def follow(self, name: str, table: DataFrame, time: str = "rt") -> DataFrame:
        """A table that :meth:`land` landed as a stream; see :meth:`followed`."""
        return self.followed(name, f"{self.base}/{name}", table, time)

    def follow_firsts(self, name: str, table: DataFrame, time: str = "rt") -> DataFrame:
        """A table that :meth:`land_firsts` landed as a stream; see :meth:`followed`."""
        return self.followed(name, f"{self.base}/{name}/{sinks.BATCH}=*", table, time)

    def followed(self, name: str, path: str, table: DataFrame, time: str) -> DataFrame:
        """A landed table as a stream in order of ``time``.

        Read as it lies it is one micro-batch, whose state is that of all its
        rows; if there are more than BATCH_ROWS it is dealt, by the cuts of the
        trade topic if there is one, so that what meets is there together.
        """
        key = f"landed-{name}"
        if key not in self.dealt and table.count() <= BATCH_ROWS:
            return streams.file_table(self.spark, path, table.schema)
        return self.deal(key, table, F.unix_timestamp(time), cuts=self.cut_at.get("trade"))

    def daily(self, rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
        """First rows per key and day, landed and read on as a stream."""
        return self.follow_firsts(name, self.land_firsts(state.first_rows(rows, keys, order), name))

    def table(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)

    def pages(self) -> DataFrame:
        return views.page_log(self.stream("events"))

    def shop_changes(self) -> DataFrame:
        return views.shop_changes(self.stream("events"))

    # Orders and what becomes of them

    def names(self) -> DataFrame:
        return views.dictionary(self.table("nation"))

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A landed table that several jobs read."""
        if name not in self.landed:
            self.landed[name] = build()
        return self.landed[name]

    def wide(self) -> DataFrame:
        """Details with their order, activity and coupon, landed."""
        return self.once("wide", lambda: self.land_wide("wide"))

    def land_wide(self, name: str, kinds: Sequence[str] = ()) -> DataFrame:
        """Wide rows, of order records of some kinds if given: two outer joins and an inner one, all of one topic.

        An outer row comes out when the watermark is past its range; the
        closing record, an order that no detail is of, takes it past all of them
        (one without an id would be filtered out before the watermark).
        """
        end = F.unix_timestamp(F.lit(END).cast("timestamp")).cast("string")
        changes = self.cuts(*WIDE)
        changes["order_info"] = facts.rows_of(self.ended(
            changes["order_info"], name, "ts", ts=end, table=F.lit("order_info"), type=F.lit("insert"),
            data=F.create_map(F.lit("id"), F.lit("end"))), "order_info", kinds)
        with streams.one_topic(self.spark):
            return self.land(facts.order_wide(changes, self.names(), within=views.FEED_RANGE), name)

    def ordered_details(self) -> DataFrame:
        """Details of new orders: of an order only its first record meets them."""
        return self.once("details", lambda: facts.order_details(self.land_wide("details", ["insert"])))

    def paid(self) -> DataFrame:
        """Payments meet the landed details: two topics, so the slower one holds the watermark."""
        def build() -> DataFrame:
            details = self.follow("details", self.ordered_details(), "pt").withWatermark("pt", "2 seconds")
            return self.land(facts.paid_details(self.trade("payment_info"), details, self.names(), within=views.FEED_RANGE), "paid")
        return self.once("paid", build)

    def refund_requests(self) -> DataFrame:
        with streams.one_topic(self.spark):
            return self.land(facts.refunds(self.cuts("order_refund_info", "order_info"), self.names(), within=views.FEED_RANGE), "order_refund")

    def refund_payments(self) -> DataFrame:
        with streams.one_topic(self.spark):
            return self.land(facts.refunds_paid(self.cuts("refund_payment", "order_refund_info", "order_info"), self.names(), within=views.FEED_RANGE), "refund_pay")

    def lines(self) -> DataFrame:
        """Details as they come, each version of a line under the line's key."""
        details = facts.rows_of(self.trade("order_detail"), "order_detail", ["insert"])
        rows = details.select(*facts.fields(*facts.ORDER_DETAIL), F.timestamp_seconds(F.col("ts").try_cast("long")).alias("pt"))
        return rows.withColumn("line", F.substring_index("id", "-", 2))

    @staticmethod
    def versions() -> list[Column]:
        """Versions of a line by ship date, then by article and supplier."""
        return [F.col("create_time"), F.col("sku_id").cast("long"), F.col("source_id").cast("long"), F.col("sku_num").cast("long"),
                F.col("split_total_amount").cast("double")]

    def first_details(self) -> DataFrame:
        """The first version of each line; the state of a line goes a day after it came."""
        return self.once("first_details", lambda: self.land_firsts(
            state.first_rows(self.lines(), ["line"], self.versions(), "pt"), "first_details"))

    def newest_details(self) -> DataFrame:
        """The newest version of each line, once none came for 5 seconds."""
        return self.once("newest_details", lambda: self.land(state.last_versions(
            self.ended(self.lines(), "newest", "pt"), ["line"], "pt", ties=self.versions()), "newest_details"))

    def with_order(self, details: DataFrame, name: str) -> DataFrame:
        """Details as a stream meet their order for its user and time, both within the range."""
        orders = facts.marked(facts.rows_of(facts.event_time(self.trade("order_info")), "order_info", ["insert"]).select(
            F.col("data")["id"].alias("order_id"), *facts.fields("user_id"), F.col("data")["create_time"].alias("made"),
            F.col("pt").alias("order_pt")), "order_pt")
        rows = facts.join_within(details.withWatermark("pt", "2 seconds"), orders, ["order_id"], "inner", views.FEED_RANGE, "order_pt")
        coupon = F.when(F.col("split_coupon_amount").cast("double") >= 0.04, F.col("split_coupon_amount"))
        return self.land(rows.select(
            "order_id", "sku_id", "user_id", "sku_num", "order_price", "split_total_amount", "split_activity_amount",
            coupon.alias("split_coupon_amount"), parse_time(F.col("made")).alias("rt")), name)

    def order_facts(self) -> DataFrame:
        return self.once("order_facts", lambda: self.with_order(
            self.follow_firsts("first_details", self.first_details(), "pt"), "order_facts"))

    # Facts

    def repaired(self) -> DataFrame:
        """Visitor flags put right batch by batch.

        The first row of each visitor is kept in a keyed table of earliest
        rows. A batch is compared with the firsts of all batches up to its
        own, so running it again gives the same rows.
        """
        pages, path = self.pages(), f"{self.base}/pages"
        firsts = KeyedTable(self.spark, f"{self.base}/first_seen", ["mid"], ["first_order"], self.partitions, pick="lowest")

        def write(rows: DataFrame, batch_id: int) -> None:
            firsts.write(logs.first_seen(rows), batch_id)
            sinks.write_batch(logs.repair_with(rows, firsts.read(up_to=batch_id)), path, batch_id)

        self.keep(pages, write, "pages")
        return self.spark.read.parquet(path).drop(sinks.BATCH)

    def visitors(self) -> DataFrame:
        entries = self.pages().where("last_page_id is null")
        return self.land_firsts(state.first_rows(entries, ["mid"], ["rt", "event_id"]), "visitors")

    def topics(self) -> DataFrame:
        """Log lines to the five outputs in one pass; the sink routes by topic."""
        logged = streams.logs(views.log_lines(self.stream("events")))
        path, checkpoint = f"{self.base}/topics", f"{self.base}/checkpoint-topics"
        sinks.to_table(logs.route(logged.where("common.mid is not null")), path, checkpoint, ["topic"]).awaitTermination()
        return self.spark.read.parquet(path)

    def rules(self, records: DataFrame) -> KeyedTable:
        """Captured changes of the routing rules, kept as a table with versions."""
        table = sinks.config_table(self.spark, f"{self.base}/rules")
        table.create(T.StructType([*CONFIG.fields, CONFIG_CHANGE["ts_ms"]]))
        self.keep(streams.config_changes(records), table.write, "rules")
        return table

    def dimensions(self, rules: KeyedTable) -> dict[str, DataFrame]:
        """Changes into every configured keyed table.

        A micro-batch takes the rules as they are at its start, and the same
        ones when it is tried again.
        """
        changes = views.part_changes(self.stream("part")).unionByName(views.customer_changes(self.stream("customer")))
        return self.dimensions_of(changes, rules)

    def dimensions_of(self, changes: DataFrame, rules: KeyedTable) -> dict[str, DataFrame]:
        base = f"{self.base}/dims"

        def write(batch: DataFrame, batch_id: int) -> None:
            sinks.write_dimensions(batch, rules.read(version=rules.version_of("dims", batch_id)).drop("ts_ms"), base, batch_id)

        self.keep(changes, write, "dims")
        return sinks.read_dimensions(self.spark, rules.read(), base)

    def enriched(self, rows: DataFrame, dim: KeyedTable, key: str, columns: dict[str, str], name: str) -> DataFrame:
        """Rows as a stream with columns of a kept dimension.

        A micro-batch sees the dimension as it is at its start, and the same
        when it is tried again; what changes later counts for later rows.
        """
        path = f"{self.base}/{name}"

        def write(batch: DataFrame, batch_id: int) -> None:
            now = dim.read(version=dim.version_of(name, batch_id))
            sinks.write_batch(dims.enrich(batch, now, key, columns, dim_key=dim.keys[0]), path, batch_id)

        self.keep(rows, write, name)
        return self.spark.read.parquet(path).drop(sinks.BATCH)

    def named_lines(self, rules: KeyedTable) -> DataFrame:
        """Lines with the trademark and name that the kept dimension of articles has."""
        self.dimensions(rules)
        articles = KeyedTable(self.spark, f"{self.base}/dims/dim_sku_info", ["id"], ["ts"])
        rows = self.stream("lineitem").select("l_orderkey", "l_linenumber", views.text("l_partkey").alias("sku_id"))
        return self.enriched(rows, articles, "sku_id", {"trademark_id": "tm_id", "sku_name": "name"}, "named_lines")

    def keep(self, df: DataFrame, write: Callable[[DataFrame, int], None], name: str) -> None:
        """Run a job that writes each micro-batch itself."""
        with self.running():
            sinks.for_each_batch(df, write, f"{self.base}/checkpoint-{name}").awaitTermination()

    def new_users(self, rows: DataFrame, name: str) -> DataFrame:
        """First rows per ``user_id`` and day with ``is_first_ever``, landed twice and read on as a stream."""
        days = self.daily(rows.select("user_id", "rt"), ["user_id"], ["rt"], f"{name}_days")
        return self.follow_firsts(f"{name}_flags", self.land_firsts(state.with_history(days, "user_id"), f"{name}_flags"))

    def bounces(self) -> DataFrame:
        pages = self.ended(self.pages(), "pages", ms="ts")
        return self.land(state.bounces(pages, "event_id", BOUNCE_MS, slots=STREAM_SLOTS), "bounces")

    # Summary tables

    def traffic(self) -> DataFrame:
        """Visitors and bounces land first; pages and both tables meet in one window."""
        visitors, jumps = self.visitors(), self.bounces()
        return self.land_summary(windows.traffic_window(
            self.ended(self.pages(), "all_pages"), self.ended(self.follow_firsts("visitors", visitors), "visitors"),
            self.ended(self.follow("bounces", jumps), "bounces"), HOUR), "traffic")

    def page_views(self) -> DataFrame:
        watched = self.pages().where("page_id in ('home', 'good_detail')")
        firsts = self.daily(watched.select("mid", "page_id", "rt", "event_id"), ["mid", "page_id"], ["rt", "event_id"], "view_days")
        return self.land(windows.page_view_window(self.ended(firsts, "views"), HOUR), "page_views")

    def logins(self) -> DataFrame:
        days = self.daily(windows.login_rows(self.pages()).select("uid", "rt"), ["uid"], ["rt"], "login_days")
        flagged = self.land_firsts(state.with_history(days, "uid", back_days=BACK_DAYS), "login_flags")
        firsts = self.follow_firsts("login_flags", flagged)
        return self.land(windows.login_window(self.ended(firsts, "logins"), HOUR), "logins")

    def registers(self) -> DataFrame:
        rows = facts.registrations(self.shop_changes()).withColumn("rt", parse_time(F.col("create_time")))
        return self.land(windows.register_window(self.ended(rows, "registers"), HOUR), "registers")

    def carts(self) -> DataFrame:
        rows = facts.cart_adds(self.shop_changes(), views.dictionary(self.table("nation")))
        rows = rows.withColumn("rt", parse_time(F.coalesce("operate_time", "create_time"))).select("user_id", "rt", "id")
        firsts = self.daily(rows, ["user_id"], ["rt", "id"], "cart_days")
        return self.land(windows.cart_window(self.ended(firsts, "carts"), HOUR), "carts")

    def keywords(self) -> DataFrame:
        rows = self.stream("documents").select(F.col("text").alias("item"), F.timestamp_seconds("doc_id").alias("rt"))
        return self.land(windows.keyword_window(self.ended(rows, "searches"), words(F.col("item"))), "keywords")

    def provinces(self) -> DataFrame:
        """Order stream by customer's province; orders count and amount per day."""
        homes = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), views.text("c_nationkey").alias("province_id"))
        rows = self.stream("orders").select(
            "o_custkey", F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("split_total_amount"),
            F.col("o_orderdate").alias("rt")).join(homes, "o_custkey", "left")
        result = windows.province_window(self.ended(rows, "orders"), DAY)
        return self.land(dims.enrich(result, views.dim_province(self.table("nation")), "province_id", {"province_name": "name"}), "provinces")

    def detail_provinces(self) -> DataFrame:
        """Orders and amounts per province and day, from the newest version of each detail."""
        rows = self.with_order(self.follow("newest_details", self.newest_details(), "pt"), "newest_facts")
        homes = self.table("customer").select(views.text("c_custkey").alias("id"), views.text("c_nationkey").alias("province_id"))
        rows = dims.enrich(self.follow("newest_facts", rows), homes, "user_id", {"province_id": "province_id"})
        result = windows.province_window(self.ended(rows.where("province_id is not null"), "newest_facts"), DAY)
        return self.land(dims.enrich(result, views.dim_province(self.table("nation")), "province_id", {"province_name": "name"}),
                         "detail_provinces")

    def with_sku(self, rows: DataFrame) -> DataFrame:
        return dims.enrich(rows, views.dim_sku(self.table("part")), "sku_id", {
            "spu_id": "spu_id", "trademark_id": "tm_id", "category3_id": "category3_id"})

    def with_names(self, result: DataFrame) -> DataFrame:
        region = self.table("region")
        result = dims.enrich(result, views.dim_trademark(self.table("part")), "trademark_id", {"trademark_name": "tm_name"})
        return dims.with_categories(result, dims.category_chain(
            views.dim_category3(self.table("nation")), views.dim_category2(region), views.dim_category1(region)))

    def orders(self) -> DataFrame:
        """Ordering and new users and amounts: flags from landed first rows, amounts from the facts, one window for both."""
        facts_table = self.order_facts()
        firsts = self.new_users(self.follow("order_facts", facts_table), "order")
        return self.land(windows.order_window_from_firsts(
            self.ended(self.follow("order_facts", facts_table), "order_facts"), self.ended(firsts, "order_firsts"), DAY), "orders")

    def user_spu(self) -> DataFrame:
        """Orders and amounts per user and article: articles come before the window, names after it."""
        rows = self.with_sku(self.follow("order_facts", self.order_facts()))
        result = windows.user_spu_window(self.ended(rows, "user_spu"), DAY)
        result = dims.enrich(result, views.dim_spu(self.table("part")), "spu_id", {"spu_name": "spu_name"})
        return self.land(self.with_names(result), "user_spu")

    def refunds(self) -> DataFrame:
        """Refund requests meet their order's user; then they are counted by trademark and category, and names come last."""
        changes = facts.event_time(self.cuts("order_refund_info", "order_info"))
        requests = facts.marked(facts.rows_of(changes, "order_refund_info", ["insert"]).select(
            *facts.fields("order_id", "sku_id", "create_time"), "pt"))
        orders = facts.marked(facts.rows_of(changes, "order_info", ["insert"]).select(
            F.col("data")["id"].alias("order_id"), *facts.fields("user_id"), F.col("pt").alias("order_pt")), "order_pt")
        rows = facts.join_within(requests, orders, ["order_id"], "inner", views.FEED_RANGE, "order_pt").select(
            "order_id", "sku_id", "user_id", parse_time(F.col("create_time")).alias("rt"))
        with streams.one_topic(self.spark):
            landed = self.land(rows, "refund_rows")
        rows = self.with_sku(self.follow("refund_rows", landed)).drop("spu_id")
        return self.land(self.with_names(windows.refund_window(self.ended(rows, "refunds"), DAY)), "refunds")

    def payments(self) -> DataFrame:
        """Paying users from payments of orders whose details are there in their newest version.

        A detail whose versions lie further apart than the hold comes out once
        per group of versions; per user and day only the first row counts, so
        that changes nothing here.
        """
        details = self.follow("newest_details", self.newest_details(), "pt").select("order_id", F.col("pt").alias("detail_pt"))
        paid = facts.rows_of(facts.event_time(self.trade("payment_info")), "payment_info", ["update"])
        paid = facts.marked(paid.where(F.col("data")["payment_status"] == facts.PAYMENT_DONE).select(
            *facts.fields("order_id", "user_id", "callback_time"), "pt"))
        rows = facts.join_within(paid, details.withWatermark("detail_pt", "2 seconds"), ["order_id"], "inner", views.FEED_RANGE, "detail_pt")
        landed = self.land(rows.select("user_id", parse_time(F.col("callback_time")).alias("rt")), "paid_rows")
        firsts = self.new_users(self.follow("paid_rows", landed), "payment")
        return self.land(windows.payment_window(self.ended(firsts, "payments"), DAY), "payments")

    def order_wide(self) -> DataFrame:
        """Lines meet their order within a range of event time, both as streams."""
        lines = self.stream("lineitem").select(
            "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_shipdate").alias("pt")).withWatermark("pt", DAY)
        orders = self.stream("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderdate").alias("order_pt")).withWatermark("order_pt", DAY)
        return self.land(facts.join_within(lines, orders, ["l_orderkey"], "inner", "30 days", "order_pt"), "order_wide")
