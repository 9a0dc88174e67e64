"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from math import ceil

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# RocksDB keeps large keyed state off the JVM heap. Skew join and adaptive
# broadcast use sizes measured at run time, so nothing is hinted by hand.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a micro-batch commits what it changed, not a snapshot of the store; a join keeps one store for both its sides
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


# Shuffles are cut into a part per PART_BYTES of compressed tables at first.
# Small parts are then joined, and files split, up to these sizes, unless the user has set others.
PART_BYTES = 2 << 20
CUT = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m", "spark.sql.files.maxPartitionBytes": "16m"}

# The shuffles of a job go from disk when it has written its rows. Without this they stay until the driver collects its
# garbage, so the shuffles of jobs that follow each other add up.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def get_session(app: str = "shopstream", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; ``extra`` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session may run without that setting: there every executor
    shares one disk, so a temporary folder is set as the base.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def sized_shuffles(spark: SparkSession, path: str) -> None:
    """Let the number of parts of the session's shuffles follow the size of the tables in a folder.

    With a fixed number a task holds more the larger the tables are. The
    number is an upper limit: Spark joins small parts by their measured size.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(stored_bytes(spark, path) / PART_BYTES))
    spark.conf.set(CUT, str(parts))
    for key, size in TASK_BYTES.items():
        spark.conf.set(key, spark.conf.get(key, None) or size)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Change a session setting for the jobs started inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs started inside; those that the user has set stay."""
    with ExitStack() as held:
        for key, value in wanted.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
                held.callback(spark.conf.unset, key)
        yield
