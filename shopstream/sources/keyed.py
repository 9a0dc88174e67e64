"""Keyed tables: one current row per key, kept as a few bucketed runs.

Every batch is written as a run, bucketed and sorted by key. Runs of one size
class are merged into one of the next once there are ``fan`` of them, so the
number of runs grows with the logarithm of the number of batches and a row is
rewritten as often. A manifest names the live runs; a new version of it is
one new file, and what no manifest names does not exist for readers. All runs
have the same buckets, so readers take the newest row per key without a
shuffle, and pay for the table's size and not for its history.

The newest run is never merged: a batch that is tried again replaces its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.operators.dedup import first_by_key

BATCH = "batch_id"


class KeyedTable:
    """The table below ``path``; ``pick`` says which row of a key counts.

    "newest": of the latest batch, then with the highest ``order`` columns.
    "highest": with the highest ``order``, whatever the batch. "lowest": with
    the lowest, a table of firsts. ``buckets`` counts when the table is created.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], buckets: int | None = None,
                 fan: int = 4, pick: str = "newest"):
        self.spark, self.path, self.keys, self.fan = spark, path, list(keys), fan
        self.buckets = buckets or spark.sparkContext.defaultParallelism
        by = [BATCH, *order] if pick == "newest" else [*order, BATCH]
        self.order = [F.col(c).asc_nulls_last() if pick == "lowest" else F.col(c).desc_nulls_last() for c in by]

    # The manifest

    def _files(self, folder: str):
        """The file system and path of a folder below the table."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _versions(self) -> list[str]:
        fs, folder = self._files("manifest")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(n for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """A version, the newest by default: {version, buckets, schema, runs: [{name, tier, first, last}]}."""
        names = self._versions() if version is None else [_file(version)] if version else []
        if not names:
            return {"version": 0, "buckets": self.buckets, "schema": None, "runs": []}
        fs, folder = self._files("manifest")
        stream = fs.open(self.spark._jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
        return json.loads(_read(self.spark, stream))

    def _publish(self, manifest: dict) -> None:
        """Write the next version: under another name first, then renamed, so that it is there whole or not at all."""
        manifest = {**manifest, "version": manifest["version"] + 1}
        fs, folder = self._files("manifest")
        new = self.spark._jvm.org.apache.hadoop.fs.Path
        draft, final = new(folder, f"draft-{uuid.uuid4().hex}"), new(folder, _file(manifest["version"]))
        out = fs.create(draft)
        out.write(json.dumps(manifest).encode())
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"another writer has published version {manifest['version']} of {self.path}")

    # Runs

    def _write_run(self, rows: DataFrame, buckets: int) -> str:
        name = f"run_{uuid.uuid4().hex}"
        rows = rows.repartition(buckets, *self.keys)
        rows.write.bucketBy(buckets, *self.keys).sortBy(*self.keys).option("path", f"{self.path}/{name}").saveAsTable(name)
        self.spark.sql(f"drop table {name}")  # only the catalog's entry: readers make their own
        return name

    def _run(self, name: str, schema: T.StructType, buckets: int) -> DataFrame:
        """A run as a bucketed table of the session, with the columns of the whole table."""
        entry = f"{name}_{len(schema.fields)}"  # columns are only ever added
        keys = ", ".join(f"`{k}`" for k in self.keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"create table if not exists {entry} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) "
                       f"into {buckets} buckets location '{self.path}/{name}'")
        return self.spark.table(entry)

    def _current(self, manifest: dict, runs: Sequence[dict]) -> DataFrame:
        # The filter is true of every row. Spark 4.1 unites the buckets of filtered scans one by one; of bare columnar
        # scans it only says so, and rows of one key would not meet.
        schema = T.StructType.fromJson(manifest["schema"])
        parts = [self._run(r["name"], schema, manifest["buckets"]).where(F.col(BATCH) >= 0) for r in runs]
        return first_by_key(reduce(DataFrame.unionByName, parts), self.keys, self.order)

    # What users call

    def create(self, schema: T.StructType) -> None:
        """Start the table without rows, or add columns it does not have yet."""
        now = self.manifest()
        merged = _merged(now["schema"], schema)
        if merged != now["schema"]:
            self._publish({**now, "schema": merged})

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch (0 or more): its row per key, replacing an earlier try; then merge runs that are due."""
        now = self.manifest()
        if any(r["first"] <= batch_id <= r["last"] and r["last"] > batch_id for r in now["runs"]):
            return  # a later batch is there, so this one was complete
        rows = first_by_key(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), self.keys, self.order)
        name = self._write_run(rows, now["buckets"])
        runs = [r for r in now["runs"] if (r["first"], r["last"]) != (batch_id, batch_id)]
        runs.append({"name": name, "tier": 0, "first": batch_id, "last": batch_id})
        self._publish({**now, "schema": _merged(now["schema"], rows.schema), "runs": runs})
        self.merge()

    def merge(self) -> None:
        """Merge the runs of every tier that has ``fan`` of them, but for the newest run."""
        while True:
            now = self.manifest()
            newest = max((r["last"] for r in now["runs"]), default=None)
            tiers: dict[int, list[dict]] = {}
            for r in now["runs"]:
                if r["last"] != newest:
                    tiers.setdefault(r["tier"], []).append(r)
            due = next((t for t in sorted(tiers) if len(tiers[t]) >= self.fan), None)
            if due is None:
                return
            old = tiers[due]
            name = self._write_run(self._current(now, old), now["buckets"])
            merged = {"name": name, "tier": due + 1, "first": min(r["first"] for r in old), "last": max(r["last"] for r in old)}
            self._publish({**now, "runs": [r for r in now["runs"] if r not in old] + [merged]})

    def version_of(self, reader: str, batch_id: int) -> int:
        """The version that a batch of a reading job sees: the newest at its first try, the same at any later one."""
        fs, folder = self._files(f"readers/{reader}")
        new = self.spark._jvm.org.apache.hadoop.fs.Path
        note = new(folder, str(batch_id))
        if fs.exists(note):
            return int(_read(self.spark, fs.open(note)))
        version = self.manifest()["version"]
        draft = new(folder, f"draft-{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(str(version).encode())
        out.close()
        fs.rename(draft, note)
        return version

    def read(self, up_to: int | None = None, version: int | None = None) -> DataFrame:
        """Current rows, or those of a version. With ``up_to``, without the runs of later batches."""
        now = self.manifest(version)
        runs = [r for r in now["runs"] if up_to is None or r["first"] <= up_to]
        if not runs:
            schema = T.StructType.fromJson(now["schema"]) if now["schema"] else T.StructType()
            return self.spark.createDataFrame([], schema).drop(BATCH)
        return self._current(now, runs).drop(BATCH)

    def clean(self, keep: int = 2) -> list[str]:
        """Remove the runs that none of the last ``keep`` manifests names, and give their names.

        Readers of an older manifest must be done by then.
        """
        fs, base = self._files(".")
        new, live = self.spark._jvm.org.apache.hadoop.fs.Path, set()
        for name in self._versions()[-keep:]:
            live |= {r["name"] for r in self.manifest(int(name.removesuffix(".json")))["runs"]}
        gone = [s.getPath().getName() for s in fs.listStatus(base) if s.getPath().getName().startswith("run_")]
        gone = [name for name in gone if name not in live]
        for name in gone:
            fs.delete(new(f"{self.path}/{name}"), True)
        return gone


def _file(version: int) -> str:
    return f"{version:012d}.json"


def _read(spark: SparkSession, stream) -> str:
    lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    text = lines.readLine()  # a manifest is one line
    lines.close()
    return text


def _merged(schema: dict | None, more: T.StructType) -> dict:
    """The table's columns and those it does not have yet; a key or column keeps its type."""
    known = T.StructType.fromJson(schema).fields if schema else []
    names = {f.name for f in known}
    fields = [T.StructField(f.name, f.dataType, True) for f in [*known, *(f for f in more.fields if f.name not in names)]]
    return T.StructType(fields).jsonValue()
