"""The summary tables of one folder of star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions.keywords import words
from shopstream.functions.times import parse_time
from shopstream.operators import dims, facts, flags, logs, windows
from shopstream.plans import views
from shopstream.session import FREED, setting, settings, shared_dir, sized_shuffles
from shopstream.sources import sinks

HOUR = "1 hour"
DAY = "1 day"

# Event gaps in the tables are hours, not seconds.
BOUNCE_MS = 6 * 3600 * 1000
BOUNCE_SLOTS = 4
BACK_DAYS = 2


class Warehouse:
    """Facts and summary tables, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        sized_shuffles(spark, sf_dir)

    def table(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)

    # Facts

    def pages(self) -> DataFrame:
        return views.page_log(self.table("events"))

    def shop_changes(self) -> DataFrame:
        return views.shop_changes(self.table("events"))

    def trade_changes(self) -> DataFrame:
        details = views.detail_changes(self.table("lineitem"))
        return details.unionByName(views.order_changes(self.table("orders")))

    def dictionary(self) -> DataFrame:
        return views.dictionary(self.table("nation"))

    def visitors(self) -> DataFrame:
        return flags.unique_visitors(self.pages(), "event_id")

    def bounces(self) -> DataFrame:
        return logs.bounces(self.pages(), "event_id", BOUNCE_MS, slots=BOUNCE_SLOTS)

    def cart_adds(self) -> DataFrame:
        return facts.cart_adds(self.shop_changes(), self.dictionary())

    def wide(self) -> DataFrame:
        return facts.order_wide(self.trade_changes(), self.dictionary())

    def first_details(self) -> DataFrame:
        return views.line_facts(views.first_lines(self.table("lineitem")), self.table("orders"))

    def last_details(self) -> DataFrame:
        return views.line_facts(views.last_lines(self.table("lineitem")), self.table("orders"))

    def refund_facts(self) -> DataFrame:
        return views.refund_facts(self.table("lineitem"), self.table("orders"))

    # Dimensions

    def sku(self) -> DataFrame:
        return views.dim_sku(self.table("part"))

    def categories(self) -> DataFrame:
        region = self.table("region")
        return dims.category_chain(
            views.dim_category3(self.table("nation")), views.dim_category2(region), views.dim_category1(region))

    def _with_sku(self, df: DataFrame) -> DataFrame:
        names = {"spu_id": "spu_id", "trademark_id": "tm_id", "category3_id": "category3_id"}
        return dims.enrich(df, self.sku(), "sku_id", names)

    def _with_names(self, df: DataFrame) -> DataFrame:
        df = dims.enrich(df, views.dim_trademark(self.table("part")), "trademark_id", {"trademark_name": "tm_name"})
        return dims.with_categories(df, self.categories())

    # Summary tables

    def traffic(self, size: str = HOUR) -> DataFrame:
        return windows.traffic_window(self.pages(), self.visitors(), self.bounces(), size)

    def page_views(self, size: str = HOUR) -> DataFrame:
        return windows.page_view_window(windows.page_firsts(self.pages()), size)

    def logins(self, size: str = HOUR) -> DataFrame:
        return windows.login_window(windows.login_firsts(windows.login_rows(self.pages()), BACK_DAYS), size)

    def registers(self, size: str = HOUR) -> DataFrame:
        rows = facts.registrations(self.shop_changes())
        return windows.register_window(rows.withColumn("rt", parse_time(F.col("create_time"))), size)

    def carts(self, size: str = HOUR) -> DataFrame:
        rows = self.cart_adds().withColumn("rt", parse_time(F.coalesce("operate_time", "create_time")))
        return windows.cart_window(windows.cart_firsts(rows), size)

    def orders(self, size: str = DAY) -> DataFrame:
        return windows.order_window(self.first_details(), size)

    def payments(self, size: str = DAY) -> DataFrame:
        return windows.payment_window(windows.payment_firsts(views.payments(self.last_details())), size)

    def provinces(self, size: str = DAY) -> DataFrame:
        rows = views.with_province(self.last_details(), self.table("customer"))
        result = windows.province_window(rows, size)
        return dims.enrich(result, views.dim_province(self.table("nation")), "province_id", {"province_name": "name"})

    def user_spu(self, size: str = DAY) -> DataFrame:
        result = windows.user_spu_window(self._with_sku(self.first_details()), size)
        result = dims.enrich(result, views.dim_spu(self.table("part")), "spu_id", {"spu_name": "spu_name"})
        return self._with_names(result)

    def refunds(self, size: str = DAY) -> DataFrame:
        return self._with_names(windows.refund_window(self._with_sku(self.refund_facts()), size))

    def searches(self) -> DataFrame:
        return self.table("documents").select(F.col("text").alias("item"), F.timestamp_seconds("doc_id").alias("rt"))

    def keywords(self, size: str = windows.SIZE) -> DataFrame:
        return windows.keyword_window(self.searches(), words(F.col("item")), size=size)


class Stored(Warehouse):
    """The same summary tables as they lie in store: partitioned by day, written once per session and state of the source."""

    _tables: dict[tuple[str, str, str, str], DataFrame] = {}

    def _source(self) -> str:
        """What the source tables are now: name, size and time of change of each."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.sf_dir)
        found = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder)
        return ",".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in found))

    def _stored(self, name: str) -> DataFrame:
        place = (self.spark.sparkContext.applicationId, self.sf_dir, self._source(), name)
        if place not in self._tables:
            rows = getattr(Warehouse(self.spark, self.sf_dir), name)()
            path = shared_dir(self.spark, f"dws-{name}")
            with settings(self.spark, FREED):  # a report of several tables has the shuffles of one of them on disk at a time
                sinks.write_summary(sinks.summary_rows(rows, [c for c in rows.columns if c not in ("stt", "edt")]), path)
            # days are listed once, by as many tasks as there are cores and not one a folder
            with setting(self.spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism",
                         str(self.spark.sparkContext.defaultParallelism)):
                self._tables[place] = self.spark.read.parquet(path).drop("ts")
        return self._tables[place]

    def traffic(self, size: str = HOUR) -> DataFrame:
        return self._stored("traffic")

    def page_views(self, size: str = HOUR) -> DataFrame:
        return self._stored("page_views")

    def logins(self, size: str = HOUR) -> DataFrame:
        return self._stored("logins")

    def registers(self, size: str = HOUR) -> DataFrame:
        return self._stored("registers")

    def carts(self, size: str = HOUR) -> DataFrame:
        return self._stored("carts")

    def orders(self, size: str = DAY) -> DataFrame:
        return self._stored("orders")

    def payments(self, size: str = DAY) -> DataFrame:
        return self._stored("payments")

    def provinces(self, size: str = DAY) -> DataFrame:
        return self._stored("provinces")

    def user_spu(self, size: str = DAY) -> DataFrame:
        return self._stored("user_spu")

    def refunds(self, size: str = DAY) -> DataFrame:
        return self._stored("refunds")

    def keywords(self, size: str = windows.SIZE) -> DataFrame:
        return self._stored("keywords")
