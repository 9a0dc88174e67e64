"""URL rules looked up in a memory-mapped, sorted array of 64-bit digests.

A rule is a host and the beginning of a path. All rules lie in one file:
their xxhash64 keys in order, then where each full string ends, the actions,
and the strings. Spark brings the file to every executor, where tasks map it
and share its pages. A URL's possible rules are few, as rules come in few
shapes (labels of the host, length of the path): their keys are searched for
in the array all at once, and a key that is found only counts if the stored
string is equal.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.session import shared_dir

from .common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ACTIONS = ["allow", "block"]
MOST_RULES, MOST_BYTES = 1 << 22, 256 << 20  # of one file


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no '://'."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _clean(rules: DataFrame) -> DataFrame:
    """(rule, action, labels, size) of each different rule of host, path, action; block wins over allow."""
    host, path = F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))
    known = F.col("action").isin(ACTIONS) & (F.col("host") != "")
    per = rules.where(known).select(F.concat(host, path).alias("rule"), "action", F.size(F.split(host, r"\.")).alias("labels"),
                                    F.length(path).alias("size"))
    return per.groupBy("rule").agg(F.max("action").alias("action"), F.first("labels").alias("labels"), F.first("size").alias("size"))


def write_index(spark: SparkSession, keys: np.ndarray, texts: list[bytes], actions: list[int]) -> str:
    """Write the file below the shared folder and have Spark bring it to every executor; returns its name."""
    order = np.argsort(keys, kind="stable")
    ends = np.cumsum([0] + [len(texts[i]) for i in order]).astype("<i8")
    body = b"".join([np.array([len(keys)], "<i8").tobytes(), keys[order].astype("<i8").tobytes(), ends.tobytes(),
                     bytes(actions[i] for i in order), *(texts[i] for i in order)])
    name = f"rules-{uuid.uuid4().hex}.bin"
    path = os.path.join(shared_dir(spark, "url-rules"), name)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)  # the shared folder need not be a local one
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    for at in range(0, len(body), 1 << 20):
        out.write(body[at:at + (1 << 20)])
    out.close()
    spark.sparkContext.addFile(path)
    return name


class Index:
    """A mapped file of rules."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view("<i8")[0])
        self.keys = raw[8:8 + 8 * n].view("<i8")
        self.ends = raw[8 + 8 * n:16 + 16 * n].view("<i8")
        self.actions, self.text = raw[16 + 16 * n:16 + 17 * n], raw[16 + 17 * n:]

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all ``keys`` at once: the first place of each, and whether the key is there."""
        at = np.searchsorted(self.keys, keys)
        inside = np.minimum(at, max(len(self.keys) - 1, 0))
        return at, (self.keys[inside] == keys) if len(self.keys) else np.zeros(len(keys), bool)

    def confirm(self, at: int, key: int, text: bytes) -> int | None:
        """The place of the rule that is ``text`` among those of one key."""
        while at < len(self.keys) and self.keys[at] == key:
            if self.text[self.ends[at]:self.ends[at + 1]].tobytes() == text:
                return at
            at += 1
        return None


def _candidates(shapes: list[tuple[int, int]]) -> list[Column]:
    """The rules of each shape that could fit; a shorter host or path gives itself, which fits as well."""
    return [F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, size)) for labels, size in shapes]


def _probe(urls: DataFrame, name: str, shapes: list[tuple[int, int]]) -> DataFrame:
    """``urls`` (_row, host, path) with rule and action, by the file called ``name``."""
    keyed = urls.withColumn("_keys", F.array(*[F.xxhash64(c) for c in _candidates(shapes)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(SparkFiles.get(name))
        for b in batches:
            keys = b["_keys"].flatten().to_numpy()
            places, there = index.hits(keys)
            best: dict[int, tuple[int, int, int, str]] = {}
            for i in np.flatnonzero(there):
                row, (labels, size) = int(i) // len(shapes), shapes[int(i) % len(shapes)]
                text = ".".join(b["host"][row].as_py().split(".")[-labels:]) + b["path"][row].as_py()[:size]
                found = index.confirm(int(places[i]), int(keys[i]), text.encode())
                if found is not None:
                    best[row] = max(best.get(row, (-1, 0, 0, "")), (len(text), labels, int(index.actions[found]), text))
            rule = [best[r][3] if r in best else None for r in range(b.num_rows)]
            action = [ACTIONS[best[r][2]] if r in best else None for r in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [b["_row"], b["host"], b["path"], pa.array(rule, pa.string()), pa.array(action, pa.string())],
                ["_row", "host", "path", "rule", "action"])

    kind = urls.schema["_row"].dataType.simpleString()
    return keyed.mapInArrow(run, f"_row {kind}, host string, path string, rule string, action string")


def _joined(urls: DataFrame, rules: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """The same by joins of different hosts and paths with the rules, for lists too large for a file."""
    places = stored(urls.select("host", "path").distinct(), "urls")
    likely = places.withColumn("rule", F.explode(F.array_distinct(F.array(*_candidates(shapes)))))
    longest = F.struct(F.length("rule"), "labels", "rule", "action")
    best = (likely.join(stored(rules, "rules"), "rule").groupBy("host", "path").agg(F.max(longest).alias("_best"))
            .select("host", "path", "_best.rule", "_best.action"))
    return urls.join(stored(best, "fits"), ["host", "path"], "left")


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", *, id_col: str = "page_id", url_col: str = "url",
          most_rules: int = MOST_RULES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """id, host, path, rule and verdict of every row of ``pages``.

    ``rules`` has host, path and action (allow or block); others are left out,
    as are those of an empty or null host; a null path is empty. A rule fits
    its host and every subdomain of it where the URL's path starts with the
    rule's. The longest rule that fits gives the verdict (then the one with
    more labels in its host; block if the list says both). ``otherwise`` is
    the verdict of a URL that is not in the array. A null or malformed URL has
    an empty host and path and no rule. Repeated rows each get a row, an empty
    table or an empty list gives no rows or no rules, other columns are left
    out. A list of more than ``most_rules`` rules or ``most_bytes`` bytes is
    joined instead of sent to the executors.
    """
    rules, spark = stored(_clean(rules), "rules"), pages.sparkSession
    host, path = host_and_path(url_col)
    urls = pages.select(F.struct(F.col(id_col).alias("id")).alias("_row"), host.alias("host"), path.alias("path"))
    n, size = rules.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("rule")), F.lit(0))).first()
    shapes = [(r.labels, r.size) for r in rules.select("labels", "size").distinct().orderBy("labels", "size").collect()]
    if not n:
        found = urls.withColumn("rule", F.lit(None).cast("string")).withColumn("action", F.lit(None).cast("string"))
    elif n > most_rules or size > most_bytes:
        found = _joined(urls, rules, shapes)
    else:
        every = rules.select("rule", "action", F.xxhash64("rule").alias("key")).collect()  # bounded by the two limits
        name = write_index(spark, np.array([r.key for r in every], np.int64), [r.rule.encode() for r in every],
                           [ACTIONS.index(r.action) for r in every])
        found = _probe(urls, name, shapes)
    return found.select(F.col("_row.id").alias(id_col), "host", "path", "rule",
                        F.coalesce("action", F.lit(otherwise)).alias("verdict"))
