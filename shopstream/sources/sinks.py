"""Sinks: Kafka, partitioned tables, keyed upserts, JDBC.

Batches are written whole under their number. Writing a batch again replaces
it, so a retry after a lost executor or driver cannot double rows. Keyed
tables are in :mod:`shopstream.sources.keyed`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shopstream.functions.times import now_ms
from shopstream.operators import dims
from shopstream.sources.keyed import BATCH, KeyedTable


def as_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def to_kafka(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> StreamingQuery:
    """Write ``value`` (and ``topic`` per row when none is given). At least once: readers dedup by key."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def to_table(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), continuous: str | None = None,
) -> StreamingQuery:
    """Append a stream to a parquet folder exactly once. Runs over what is there
    unless a ``continuous`` trigger interval is given."""
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**trigger).start(path)


def for_each_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    continuous: str | None = None,
) -> StreamingQuery:
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def summary_rows(dws: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a summary table: the named columns, write time ``ts``, and the day ``dt`` to partition by."""
    return dws.select("stt", "edt", *columns, now_ms().alias("ts"), F.col("stt").cast("date").alias("dt"))


def write_summary(rows: DataFrame, path: str) -> None:
    """Write rows of :func:`summary_rows` by day. Spark gathers small days and splits large ones by their measured size."""
    rows.hint("rebalance", F.col("dt")).write.mode("append").partitionBy("dt").parquet(path)


def write_summary_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch of :func:`summary_rows` by day and batch number: an earlier try of the batch is replaced day by day."""
    (rows.withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", F.col("dt")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dt", BATCH).parquet(path))


def to_summary(dws: DataFrame, path: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Land a stream of closed windows in a summary table, with write time and by day."""
    columns = [c for c in dws.columns if c not in ("stt", "edt")]
    return for_each_batch(dws, lambda rows, batch_id: write_summary_batch(summary_rows(rows, columns), path, batch_id),
                          checkpoint, continuous=continuous)


def create_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ("id",)) -> None:
    """Start a keyed table without rows, unless it is there; columns it does not have are added."""
    KeyedTable(spark, path, keys, []).create(schema)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write the rows of one batch to a folder of its own, replacing an earlier try."""
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def to_batches(df: DataFrame, path: str, checkpoint: str, mode: str = "update", continuous: str | None = None) -> StreamingQuery:
    """Land a stream in folders, one a micro-batch; for streams in update mode, whose rows come once all the same."""
    return for_each_batch(df, lambda rows, batch_id: write_batch(rows, path, batch_id), checkpoint, mode, continuous)


def upsert_batches(path: str, keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes the newest row per key of each batch."""
    return lambda rows, batch_id: KeyedTable(rows.sparkSession, path, keys, order).write(rows, batch_id)


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current rows of a keyed table: highest batch, then highest ``order``, per key."""
    return KeyedTable(spark, path, keys, order).read()


def write_dimensions(changes: DataFrame, config: DataFrame, base: str, batch_id: int) -> None:
    """Write a batch of change records into every configured table below ``base``.

    A table that is not there yet is created, and columns that a rule has
    gained are added, null in older rows. The rules, one per table, are read
    again for every batch, so a new one takes effect with the next.
    """
    routed = dims.route(dims.upserts(changes), config)
    for rule in config.collect():  # one row per dimension
        names = dims.sink_schema(rule.asDict()).names
        rows = dims.columns_of(routed, rule.asDict()).select(*names, "ts")
        table = KeyedTable(changes.sparkSession, f"{base}/{rule['sink_table']}", [rule["sink_pk"] or dims.DEFAULT_KEY], ["ts"])
        table.create(rows.schema)
        table.write(rows, batch_id)


def config_table(spark: SparkSession, path: str) -> KeyedTable:
    """The routing rules as they were at each version: one row per source table, kept from its change records."""
    return KeyedTable(spark, path, ["source_table"], ["ts_ms"], buckets=1, pick="highest")


def read_dimensions(spark: SparkSession, config: DataFrame, base: str) -> dict[str, DataFrame]:
    """Current rows of every configured table, by name."""
    return {r["sink_table"]: read_upserts(spark, f"{base}/{r['sink_table']}", [r["sink_pk"] or dims.DEFAULT_KEY], ["ts"]).drop("ts")
            for r in config.collect()}


def to_jdbc(url: str, table: str, batch_rows: int = 10_000, **options: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends to a database table. Needs the database's driver.

    At least once: a batch that is tried again appends its rows again, so the
    table's readers must take one row per key.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.format("jdbc").mode("append").options(
            url=url, dbtable=table, batchsize=str(batch_rows), **options).save()
    return write
