"""The corpus queries against their SQL, and the pipeline stage by stage."""

import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopstream.llm import mixing, queries

sys.path.insert(0, "tools")
from tools import check  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    result = check.compare(spark, con, SF, name)
    assert result.startswith("ok") and "types" not in result, result


@pytest.mark.parametrize("name", ["op1_mixing", "op8_line_dedup", "op9_host_quality", "op10_sharding"])
def test_native_plans_hold_no_python(spark, name):
    df = queries.queries()[name](spark, SF)
    text = df._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text and "CartesianProduct" not in text


def test_names_of_the_queries():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


def test_shards_of_the_query(spark):
    rows = queries.op10_sharding(spark, SF).collect()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_held_out_languages(spark):
    rows = queries.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert held[0] >= 0.95 and held[1] > 20


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mixing", "bpe"]
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[1] <= sizes[0] and sizes[2] == sizes[1] and sizes[3] < sizes[2] and sizes[4] == sizes[3]
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    want = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in tokens.collect()} == want
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_the_mix_reaches_the_tokens_whatever_the_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    want = {r.doc_id: (r.position, r.in_mix) for r in mixing.mix(docs, queries.TARGETS, queries.BLOCK).collect()}
    sizes = F.pmod(F.xxhash64("doc_id"), F.lit(100))
    many = stages["mixing"](spark, docs, SF).repartition(12, F.when(sizes < 50, 0).otherwise(sizes))
    many.write.parquet(f"{tmp_path}/mixed")
    got = stages["bpe"](spark, spark.read.parquet(f"{tmp_path}/mixed"), SF)
    assert {r.doc_id: (r.position, r.in_mix) for r in got.collect()} == want
    assert [r.doc_id for r in got.orderBy("position").collect()] == sorted(want, key=want.get)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, None, "en", "a", None)],
                                  [(1, "alone and well " * 40, "en", "a", 600), (1, "alone and well " * 40, "en", "a", 600), (3, "x" * 200000, "de", None, None)]])
def test_odd_documents_pass_through_the_pipeline(spark, tmp_path, rows):
    extra = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("own")).withColumn("slot", F.lit(2))
    extra.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    letters = {r[0] for r in rows if r[1] and any(map(str.isalpha, r[1]))}
    assert sorted(r.doc_id for r in got) == sorted(letters)


def test_the_tokens_follow_the_mix_that_the_stage_before_decided_on(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "web" if i % 2 else "books", 6) for i in range(200)], DOCS)
    stages = dict(corpus_pipeline.STAGES)
    plain = stages["bpe"](spark, docs, SF).select("position", "in_mix").distinct().collect()
    assert [tuple(r) for r in plain] == [(None, None)]
    other = {"web": 3, "books": 1}
    monkeypatch.setattr(queries, "TARGETS", other)
    stages["mixing"](spark, docs, SF).write.parquet(f"{tmp_path}/mixed")
    monkeypatch.undo()
    got = stages["bpe"](spark, spark.read.parquet(f"{tmp_path}/mixed"), SF).collect()
    want = {r.doc_id: (r.position, r.in_mix) for r in mixing.mix(docs, other, queries.BLOCK).collect()}
    assert {r.doc_id: (r.position, r.in_mix) for r in got} == want
