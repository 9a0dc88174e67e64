"""Fixed schemas of the inputs."""

from pyspark.sql import types as T

STRINGS = T.MapType(T.StringType(), T.StringType())


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


COMMON = strings("mid", "uid", "vc", "ch", "ar", "is_new")

PAGE = T.StructType([
    *strings("page_id", "last_page_id", "item", "item_type").fields,
    T.StructField("during_time", T.LongType()),
])

# `start` and `err` keep their JSON text; the fields of displays and actions
# are open, so they stay maps.
LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(STRINGS)),
    T.StructField("actions", T.ArrayType(STRINGS)),
    T.StructField("start", T.StringType()),
    T.StructField("err", T.StringType()),
    T.StructField("ts", T.LongType()),
])

CHANGE = T.StructType([
    *strings("database", "table", "type").fields,
    T.StructField("data", STRINGS),
    T.StructField("old", STRINGS),
    T.StructField("ts", T.StringType()),
])

CONFIG = strings("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")

# A captured change of a routing rule: the rule after it, and when it was made.
CONFIG_CHANGE = T.StructType([T.StructField("after", CONFIG), T.StructField("ts_ms", T.LongType())])

DICTIONARY = T.StructType([
    *strings("dic_code", "dic_name", "parent_code").fields,
    T.StructField("create_time", T.TimestampType()),
    T.StructField("operate_time", T.TimestampType()),
])
