"""Sources: Kafka topics, files, JDBC dictionary, and the parsing of both record kinds."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.operators.dedup import first_by_key
from shopstream.schemas import CHANGE, CONFIG_CHANGE, DICTIONARY, LOG
from shopstream.session import setting

BAD = "_corrupt_record"


def kafka_lines(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str) -> DataFrame:
    """Topic as text lines; a null value reads as ''. The checkpoint holds the offsets.

    Needs the spark-sql-kafka package on the cluster.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting).options(**options)
    )
    return text_lines(reader.load())


def text_lines(records: DataFrame) -> DataFrame:
    """``value`` as text, '' for a null value (a tombstone of an upsert topic)."""
    return records.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))


def kafka_table(spark: SparkSession, servers: str, topic: str, schema: T.StructType, **options: str) -> DataFrame:
    """Topic of JSON rows as columns."""
    return parse(kafka_lines(spark, servers, topic, **options), schema)


def kafka_changes(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Topic of change records."""
    return kafka_table(spark, servers, topic, CHANGE, **options)


def one_topic(spark: SparkSession) -> AbstractContextManager[None]:
    """Start a job whose inputs are all cut from one topic.

    Filters move below the watermark, so each cut tells its own time. The
    furthest of them is the time of the topic; without this, a quiet source
    table would hold the whole job back. Jobs over several topics must keep
    Spark's default, which waits for the slowest.
    """
    return setting(spark, "spark.sql.streaming.multipleWatermarkPolicy", "max")


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files that arrive in a folder, as a stream of lines."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def file_table(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    # A bad line gives a struct of nulls, or a null for '', so the line itself
    # is kept in an extra field to tell it apart. The explode keeps the filters
    # that follow from being pushed into the projection, which would parse the
    # line again for each of them.
    marked = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    row = F.from_json("value", marked, {"columnNameOfCorruptRecord": BAD})
    return lines.select("value", F.explode(F.array(row)).alias("row"))


_IS_BAD = f"row is null or row.{BAD} is not null"


def parse(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines as columns; lines that do not parse are dropped."""
    return _parsed(lines, schema).where(f"not ({_IS_BAD})").select(*(F.col(f"row.{n}").alias(n) for n in schema.names))


def dirty(lines: DataFrame, schema: T.StructType = LOG) -> DataFrame:
    """The lines :func:`parse` drops."""
    return _parsed(lines, schema).where(_IS_BAD).select("value")


def logs(lines: DataFrame) -> DataFrame:
    return parse(lines, LOG)


def changes(lines: DataFrame) -> DataFrame:
    return parse(lines, CHANGE)


def config_records(lines: DataFrame) -> DataFrame:
    """Captured config changes from their JSON lines."""
    return parse(lines, CONFIG_CHANGE)


def jdbc_dictionary(spark: SparkSession, url: str, table: str = "base_dic", **options: str) -> DataFrame:
    """Code dictionary over JDBC; read again for every batch of a stream. Needs the database's driver."""
    rows = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in DICTIONARY.fields))


def config_rows(records: DataFrame) -> DataFrame:
    """Routing rules from captured config changes: the row after the change, newest per source table.

    ``records`` holds ``after`` (struct of the rule) and ``ts_ms``.
    """
    return first_by_key(config_changes(records), ["source_table"], [F.col("ts_ms").desc_nulls_last()]).drop("ts_ms")


def config_changes(records: DataFrame) -> DataFrame:
    """The rules of captured config changes with their time ``ts_ms``; records without a rule after them are left out."""
    return records.where("after is not null").select("after.*", "ts_ms")
