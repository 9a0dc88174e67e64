"""Keyed tables: what readers see after many batches, retries, crashes and new columns, and at which cost."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shopstream.session import shared_dir
from shopstream.sources.keyed import KeyedTable
from tests.conftest import rows


def batch(spark, *data):
    return spark.createDataFrame(list(data), "id string, name string, ts long")


def folders(table):
    return [f for f in os.listdir(table.path) if f.startswith("run_")]


def test_many_batches_cost_few_files_and_no_shuffle(spark):
    rnd, want = random.Random(1), {}
    table = KeyedTable(spark, shared_dir(spark, "keyed"), ["id"], ["ts"], buckets=4, fan=3)
    for b in range(50):
        data = [(f"k{rnd.randrange(60)}", f"b{b}-{i}", rnd.randrange(5)) for i in range(20)]
        table.write(batch(spark, *data).repartition(3), b)
        newest = {}
        for k, name, ts in data:
            newest[k] = max(newest.get(k, (-1, "")), (ts, name))
        # of rows of one time in one batch any may count
        want |= {k: {n for key, n, t in data if key == k and t == newest[k][0]} for k in newest}
    got = table.read()
    assert {r.id for r in got.collect()} == set(want) and got.count() == len(want) == got.select("id").distinct().count()
    assert all(r["name"] in want[r.id] for r in got.collect())
    runs = table.manifest()["runs"]
    assert len(runs) <= 2 * 4 + 1 and sorted(b for r in runs for b in range(r["first"], r["last"] + 1)) == list(range(50))
    assert len(got.inputFiles()) <= 4 * len(runs)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == len(runs)
    live = {r["name"] for r in runs}
    table.clean(keep=1)
    assert set(folders(table)) == live and rows(table.read()) == rows(got)


@pytest.mark.parametrize("pick", ["newest", "lowest"])
def test_a_batch_tried_again_replaces_its_own(spark, pick):
    table = KeyedTable(spark, shared_dir(spark, "keyed"), ["id"], ["ts"], buckets=2, fan=2, pick=pick)
    for b in range(6):
        data = batch(spark, ("a", f"a{b}", 10 - b), (f"n{b}", "x", b))
        for _ in range(1 + b % 2):
            table.write(data, b)
    table.write(batch(spark, ("a", "of an old batch", 99)), 2)  # that one is long complete
    assert rows(table.read(), "id", "name") == [("a", "a5")] + [(f"n{b}", "x") for b in range(6)]
    if pick == "newest":
        assert rows(table.read(up_to=4), "id", "name") == [("a", "a4")] + [(f"n{b}", "x") for b in range(5)]


def test_earliest_rows_stay(spark):
    table = KeyedTable(spark, shared_dir(spark, "firsts"), ["id"], ["ts"], buckets=2, fan=2, pick="lowest")
    for b, (ts, name) in enumerate([(5, "five"), (7, "seven"), (3, "three"), (4, "four"), (3, "three again")]):
        table.write(batch(spark, ("a", name, ts), (None, "no key", ts)), b)
    assert rows(table.read(), "id", "name") == [(None, "no key"), ("a", "three")]
    assert table.read().select("id").count() == 2


def test_a_crash_between_merge_and_manifest_loses_nothing(spark, monkeypatch):
    table = KeyedTable(spark, shared_dir(spark, "keyed"), ["id"], ["ts"], buckets=2, fan=2)
    table.write(batch(spark, ("a", "a0", 1), ("b", "b0", 1)), 0)
    table.write(batch(spark, ("a", "a1", 1)), 1)
    publish, tries = KeyedTable._publish, []

    def crash(self, manifest):
        tries.append(len(manifest["runs"]))
        if len(tries) == 2:  # the batch is published, the merge is not
            raise OSError("lost")
        publish(self, manifest)

    monkeypatch.setattr(KeyedTable, "_publish", crash)
    with pytest.raises(OSError):
        table.write(batch(spark, ("c", "c2", 1)), 2)
    monkeypatch.setattr(KeyedTable, "_publish", publish)
    want = [("a", "a1"), ("b", "b0"), ("c", "c2")]
    assert rows(table.read(), "id", "name") == want and len(folders(table)) == 4
    table.write(batch(spark, ("c", "c2", 1)), 2)  # the stream tries the batch again, and the merge with it
    assert rows(table.read(), "id", "name") == want and len(table.manifest()["runs"]) == 2
    assert len(table.clean(keep=1)) == 4 and rows(table.read(), "id", "name") == want


def test_new_columns_reach_old_runs(spark):
    table = KeyedTable(spark, shared_dir(spark, "keyed"), ["id"], ["ts"], buckets=2)
    table.write(batch(spark, ("a", "a0", 1), ("b", "b0", 1)), 0)
    version = table.manifest()["version"]
    table.write(batch(spark, ("b", "b1", 1)).withColumn("color", F.lit("red")), 1)
    table.write(batch(spark, ("c", "c2", 1)).drop("name"), 2)
    assert rows(table.read(), "id", "name", "color") == [("a", "a0", None), ("b", "b1", "red"), ("c", None, None)]
    assert rows(table.read(version=version)) == [("a", "a0", 1), ("b", "b0", 1)]


def test_a_version_is_kept_for_a_batch_that_is_tried_again(spark):
    table = KeyedTable(spark, shared_dir(spark, "rules"), ["id"], ["ts"], buckets=1)
    table.create(batch(spark).schema)
    assert table.read().count() == 0 and table.read().columns == ["id", "name", "ts"]
    seen = table.version_of("job", 0)
    table.write(batch(spark, ("a", "a0", 1)), 0)
    assert table.version_of("job", 0) == seen and table.version_of("job", 1) > seen
    assert table.read(version=table.version_of("job", 0)).count() == 0


def test_a_table_without_a_row_and_a_session_of_its_own(spark):
    path = shared_dir(spark, "keyed")
    KeyedTable(spark, path, ["id"], ["ts"], buckets=3).write(batch(spark), 0)
    KeyedTable(spark, path, ["id"], ["ts"], buckets=7).write(batch(spark, ("a", "a1", 1)), 1)  # the table's buckets count
    other = KeyedTable(spark.newSession(), path, ["id"], ["ts"])
    assert rows(other.read(), "id", "name") == [("a", "a1")] and other.manifest()["buckets"] == 3
