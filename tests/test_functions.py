import random
import re
import time

from pyspark.sql import functions as F

from shopstream.functions import keywords, money, times
from tests.conftest import at, rows


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_times_read_and_write_text(spark):
    ms = F.lit(1704067200123)
    assert one(spark, times.to_date_text(ms), times.to_time_text(ms)) == ("2024-01-01", "2024-01-01 00:00:00")
    assert one(spark, times.to_ts(F.lit("2024-01-01")), times.to_ts(F.lit("2024-01-01 00:00:01"))) == (1704067200000, 1704067201000)
    assert one(spark, times.second_of_ms(ms), times.time_of_ms(ms)) == (at("2024-01-01"), at("2024-01-01T00:00:00.123"))
    assert one(spark, times.date_text(F.lit("2024-02-03 04:05:06")), times.date_text(F.lit("no time"))) == ("2024-02-03", None)
    assert one(spark, times.date_part(F.lit("2024-02-03 04:05:06"))) == ("2024-02-03",)
    assert one(spark, times.day_number(F.lit("2024-02-03").cast("timestamp"))) == (20240203,)


def test_compare_times_ignores_trailing_zeros(spark):
    def compare(a, b):
        return one(spark, times.compare_times(F.lit(a), F.lit(b)))[0]

    assert compare("2022-04-01T10:20:47.040Z", "2022-04-01T10:20:47.04Z") == 0
    assert compare("2022-04-01T10:20:47.04Z", "2022-04-01T10:20:47.041Z") == -1
    assert compare("2022-04-01T10:20:47.302Z", "2022-04-01T10:20:47.3Z") == 1
    assert compare("junk", "2022-04-01T10:20:47.3Z") is None


def test_on_day_is_a_range(spark):
    df = spark.createDataFrame([(at("2024-01-01T23:59:59"),), (at("2024-01-02"),), (at("2024-01-03"),)], "t timestamp")
    assert rows(df.where(times.on_day(F.col("t"), "2024-01-02"))) == [(at("2024-01-02"),)]


def test_money_sums_are_exact_and_order_free(spark):
    df = spark.createDataFrame([("0.1",), ("0.2",), (None,), ("-0.05",), ("bad",)], "a string")
    assert df.agg(money.total(money.minor(F.col("a")))).first()[0] == 0.25
    assert one(spark, money.ratio(F.lit(1), F.lit(0)), money.ratio(F.lit(1), F.lit(4))) == (None, 0.25)


def test_words_split_on_everything_but_letters_and_digits(spark):
    assert one(spark, keywords.words(F.lit("Red  phone-case, X2! été"))) == (["red", "phone", "case", "x2", "été"],)
    assert one(spark, keywords.words(F.lit(" .. "))) == ([],)


def test_dictionary_takes_the_longest_word(spark):
    listed = keywords.load_words(["大数据 7 n", "今天学习 7 n", "", "数据 3 n", "今天 3 n"])
    found = one(spark, keywords.dictionary_words(F.lit("今天学习大数据项目Flink 3"), listed))[0]
    assert found == ["今天学习", "大数据", "项", "目", "Flink", "3"]
    assert one(spark, keywords.dictionary_words(F.lit("a.b 数据"), ["a.b"]))[0] == ["a.b", "数", "据"]


def long_list(n, seed=4):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefgh数据大今天学") for _ in range(rnd.randint(2, 7))) for _ in range(n)] + ["a.b", "x y", "大数据"]


def plain_split(text, listed):
    out, at = [], 0
    while at < len(text):
        word = next((w for n in range(12, 0, -1) if (w := text[at:at + n]) in listed and len(w) == n), None)
        if word is None:
            run = re.match("[A-Za-z0-9]+", text[at:])
            word = run.group() if run else text[at] if text[at].isalnum() else ""
        out += [word] if word else []
        at += len(word) or 1
    return out


def test_a_long_dictionary_equals_a_plain_search(spark):
    rnd = random.Random(9)
    listed = long_list(20_000)
    texts = ["".join(rnd.choice("abcdefgh数据大今天学 .7é") for _ in range(rnd.randrange(60))) for _ in range(200)] + ["", None]
    texts += ["".join(rnd.choices(listed, k=300))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    found = {r.id: r.w for r in df.select("id", keywords.dictionary_words(F.col("t"), listed).alias("w")).collect()}
    assert found == {i: None if t is None else plain_split(t, set(listed)) for i, t in enumerate(texts)}
    # the pattern of a short list and the tables of a long one agree
    few = listed[:150] + ["a.b", "x y"]
    by_pattern = {r.id: r.w for r in df.select("id", keywords.dictionary_words(F.col("t"), few).alias("w")).collect()}
    split = keywords.longest_match(few)
    assert by_pattern == {i: None if t is None else split(t) for i, t in enumerate(texts)}


def test_a_thousand_times_the_words_cost_little_more():
    text = "".join(random.Random(2).choice("abcdefgh数据大今天学 ") for _ in range(200_000))
    took = []
    for n in (200, 200_000):
        split = keywords.longest_match(long_list(n))
        split(text)
        start = time.perf_counter()
        split(text)
        took.append(time.perf_counter() - start)
    assert took[1] < 3 * took[0]


def test_table_function_in_sql(spark):
    keywords.register(spark)
    spark.createDataFrame([(1, "Red phone"), (2, None), (3, "red")], "id int, item string").createOrReplaceTempView("items")
    df = spark.sql("select id, word from items, lateral split_words(item)")
    assert rows(df) == [(1, "phone"), (1, "red"), (3, "red")]
