from shopstream.operators import dims
from shopstream.schemas import CHANGE, CONFIG
from shopstream.session import shared_dir
from shopstream.sources import sinks, streams
from tests.conftest import rows

RULE = {"source_table": "sku", "sink_table": "dim_sku", "sink_columns": "id,name", "sink_pk": None, "sink_extend": None}


def topic(spark, *records):
    return spark.createDataFrame([("shop", t, k, d, None, ts) for t, k, d, ts in records], CHANGE)


def test_route_keeps_configured_tables_and_columns(spark):
    df = topic(
        spark, ("sku", "insert", {"id": "1", "name": "x", "price": "3"}, "1"), ("sku", "delete", {"id": "2"}, "1"),
        ("sku", "bootstrap-insert", {"id": "3"}, "1"), ("sku", "bootstrap-start", {}, "1"), ("log", "insert", {"id": "4"}, "1"))
    routed = dims.route(dims.upserts(df), spark.createDataFrame([tuple(RULE.values())], CONFIG))
    assert sorted((r.sink_table, r.sink_pk, sorted(r.data.items())) for r in routed.collect()) == [
        ("dim_sku", "id", [("id", "1"), ("name", "x")]), ("dim_sku", "id", [("id", "3")])]
    assert rows(dims.columns_of(routed, RULE), "id", "name", "type") == [("1", "x", "insert"), ("3", None, "bootstrap-insert")]


def test_sink_schema():
    schema = dims.sink_schema(RULE)
    assert schema.simpleString() == "struct<id:string,name:string>"
    assert [f.nullable for f in schema] == [False, True]
    assert [f.nullable for f in dims.sink_schema(RULE | {"sink_pk": "name"})] == [True, False]


def test_newest_config_row_counts(spark):
    schema = f"ts_ms long, after struct<{', '.join(f'{n}:string' for n in CONFIG.names)}>"
    df = spark.createDataFrame([
        (1, ("sku", "old", "id", "id", None)), (2, ("sku", "new", "id,name", "id", None)), (1, ("spu", "dim_spu", "id", "", None)), (3, None)], schema)
    assert rows(streams.config_rows(df), "source_table", "sink_table") == [("sku", "new"), ("spu", "dim_spu")]


def test_enrich_trims_keys_and_keeps_unknown(spark):
    df = spark.createDataFrame([("1 ", "a"), ("2", "b"), (None, "c")], "k string, v string")
    dim = spark.createDataFrame([(" 1", "one")], "id string, name string")
    assert rows(dims.enrich(df, dim, "k", {"n": "name"}), "v", "n") == [("a", "one"), ("b", None), ("c", None)]


def test_category_chain(spark):
    c3 = spark.createDataFrame([("31", "phones", "21"), ("32", "lost", "29"), ("33", "half", "22")], "id string, name string, category2_id string")
    c2 = spark.createDataFrame([("21", "mobile", "11 "), ("22", "x", "19")], "id string, name string, category1_id string")
    c1 = spark.createDataFrame([("11", "electronics")], "id string, name string")
    df = spark.createDataFrame([("31",), ("32",), ("33",), ("99",)], "category3_id string")
    got = dims.with_categories(df, dims.category_chain(c3, c2, c1))
    assert rows(got, "category3_id", "category3_name", "category2_name", "category1_name") == [
        ("31", "phones", "mobile", "electronics"), ("32", "lost", None, None), ("33", "half", "x", None), ("99", None, None, None)]


def batch(spark, *data):
    return spark.createDataFrame(list(data), "id string, name string, ts long")


def test_keyed_table_survives_a_repeated_batch(spark):
    path = shared_dir(spark, "keyed")
    write = sinks.upsert_batches(path, ["id"], ["ts"])
    write(batch(spark, ("1", "a", 1), ("1", "b", 2), ("2", "c", 1)), 0)
    write(batch(spark, ("2", "d", 0), ("3", "e", 1)), 1)
    write(batch(spark, ("2", "d", 0), ("3", "e", 1)), 1)
    want = [("1", "b"), ("2", "d"), ("3", "e")]
    assert rows(sinks.read_upserts(spark, path, ["id"], ["ts"]), "id", "name") == want
    sinks.upsert_batches(path, ["id"], ["ts"])(batch(spark, ("1", "z", 0)), 2)
    assert rows(sinks.read_upserts(spark, path, ["id"], ["ts"]), "id", "name") == [("1", "z"), *want[1:]]


def test_table_from_a_rule_starts_empty(spark):
    path = shared_dir(spark, "new")
    schema = dims.sink_schema(RULE)
    sinks.create_table(spark, path, schema)
    assert rows(sinks.read_upserts(spark, path, ["id"], [])) == []
    sinks.upsert_batches(path, ["id"], ["name"])(spark.createDataFrame([("1", "a")], schema), 0)
    sinks.create_table(spark, path, schema)
    assert rows(sinks.read_upserts(spark, path, ["id"], [])) == [("1", "a")]


def test_summary_rows(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:00:10", 1, "helper")], "stt string, edt string, n long, ids string")
    got = sinks.summary_rows(df, ["n"])
    assert got.columns == ["stt", "edt", "n", "ts", "dt"]
    assert got.first().ts > 1_700_000_000_000
