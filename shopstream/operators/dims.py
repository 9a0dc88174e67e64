"""Dimension tables: routing of change records, enrichment, category chain.

No join here is hinted. Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both, splitting
skewed partitions; a dimension that outgrows the limit changes the plan, not
the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed change types that carry a dimension row; deletes are ignored.
UPSERT_TYPES = ["insert", "update", "bootstrap-insert"]
DEFAULT_KEY = "id"


def upserts(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("type").isin(UPSERT_TYPES))


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Keep changes of configured tables, cut ``data`` to the configured columns
    and add ``sink_table`` and ``sink_pk``."""
    rules = config.select(
        F.col("source_table").alias("table"),
        "sink_table",
        F.split("sink_columns", ",").alias("_columns"),
        F.coalesce(F.nullif("sink_pk", F.lit("")), F.lit(DEFAULT_KEY)).alias("sink_pk"),
    )
    kept = F.map_filter("data", lambda k, _: F.array_contains("_columns", k))
    return changes.join(rules, "table").withColumn("data", kept).drop("_columns")


def sink_schema(rule: Mapping[str, str | None]) -> T.StructType:
    """Schema of a configured table: all strings, the key not null."""
    key = rule["sink_pk"] or DEFAULT_KEY
    return T.StructType([
        T.StructField(c, T.StringType(), nullable=c != key) for c in rule["sink_columns"].split(",")
    ])


def columns_of(routed: DataFrame, rule: Mapping[str, str | None]) -> DataFrame:
    """Routed rows of one configured table as columns, other columns kept."""
    names = sink_schema(rule).names
    rest = [c for c in routed.columns if c not in {"data", "old", *names}]
    rows = routed.where(F.col("sink_table") == rule["sink_table"])
    return rows.select(*(F.col("data")[n].alias(n) for n in names), *rest)


def enrich(
    df: DataFrame, dim: DataFrame, key: str | Column, columns: Mapping[str, str], dim_key: str = DEFAULT_KEY,
) -> DataFrame:
    """Add dimension ``columns`` (new name -> dimension column) by key.

    Keys are compared without surrounding blanks. A key the dimension does not
    hold gives nulls. The dimension must hold a key once.
    """
    side = dim.select(F.trim(dim_key).alias("_key"), *(F.col(c).alias(n) for n, c in columns.items()))
    key = F.col(key) if isinstance(key, str) else key
    return df.join(side, F.trim(key) == F.col("_key"), "left").drop("_key")


def category_chain(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """One row per third-level category with the names and keys above it."""
    chain = category3.select(
        F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), F.trim("category2_id").alias("category2_id"),
    )
    chain = enrich(chain, category2, "category2_id", {"category2_name": "name", "category1_id": "category1_id"})
    return enrich(chain, category1, "category1_id", {"category1_name": "name"})


def with_categories(df: DataFrame, chain: DataFrame) -> DataFrame:
    """Add all category columns to a frame that holds ``category3_id``."""
    names = [c for c in chain.columns if c != "category3_id"]
    return enrich(df, chain, "category3_id", dict(zip(names, names)), dim_key="category3_id")
