import random
from datetime import date, timedelta

import pytest

from shopstream.operators import dedup, flags, windows
from tests.conftest import at, rows


def test_first_and_last_by_key(spark):
    df = spark.createDataFrame([
        ("a", 1, 10, "x"), ("a", 2, 10, "y"), ("a", 3, 9, "z"), ("b", 1, None, "n"), ("b", 2, 5, "m"),
    ], "id string, seq int, ver int, v string")
    assert rows(dedup.first_by_key(df, ["id"], ["seq"]), "id", "v") == [("a", "x"), ("b", "n")]
    # equal versions: the newcomer wins; a null version never beats a known one
    assert rows(dedup.last_by_key(df, ["id"], "ver", ["seq"]), "id", "v") == [("a", "y"), ("b", "m")]


def random_rows(seed, n=400):
    """A key with a third of all rows, times with duplicates, three weeks."""
    rnd = random.Random(seed)
    start = at("2024-01-01")
    out = []
    for i in range(n):
        user = "hot" if rnd.random() < 0.34 else f"u{rnd.randrange(25)}"
        out.append((user, start + timedelta(seconds=rnd.randrange(0, 21 * 86400, 900)), i))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_flag_rows_against_a_loop(spark, seed):
    data = random_rows(seed)
    seen_days, seen, want = set(), set(), []
    for user, rt, i in sorted(data, key=lambda r: (r[1], r[2])):
        want.append((i, (user, rt.date()) not in seen_days, user not in seen))
        seen_days.add((user, rt.date()))
        seen.add(user)
    df = spark.createDataFrame(data, "user string, rt timestamp, i int")
    got = flags.flag_rows(df, "user", "rt", "i")
    assert got.count() == len(data)
    assert rows(got, "i", "is_daily_first", "is_first_ever") == sorted(want)
    firsts = flags.with_first_ever(flags.daily_first(df, ["user"], "rt"), "user")
    by_time = sorted(data, key=lambda r: r[1])
    times = {}
    for user, rt, _ in by_time:
        times.setdefault((user, rt.date()), rt)
    first_day = {}
    for user, day in times:
        first_day[user] = min(day, first_day.get(user, day))
    assert rows(firsts, "user", "rt", "is_first_ever") == sorted(
        (u, rt, first_day[u] == d) for (u, d), rt in times.items())


def test_returning_needs_the_full_gap(spark):
    days = {"a": [1, 2], "b": [1, 8], "c": [1, 9], "d": [1, 9, 17, 18]}
    data = [(u, at(f"2024-01-{d:02d}T08:00:00")) for u, ds in days.items() for d in ds]
    df = spark.createDataFrame(data, "uid string, rt timestamp")
    back = windows.login_firsts(df, 8).where("is_back")
    assert rows(back, "uid", "dt") == [("c", date(2024, 1, 9)), ("d", date(2024, 1, 9)), ("d", date(2024, 1, 17))]


def test_unique_visitors_only_entries(spark):
    df = spark.createDataFrame([
        ("m", None, at("2024-01-01T10:00:00"), 1), ("m", "home", at("2024-01-01T09:00:00"), 2),
        ("m", None, at("2024-01-01T11:00:00"), 3), ("m", None, at("2024-01-02T00:00:00"), 4),
    ], "mid string, last_page_id string, rt timestamp, n int")
    assert rows(flags.unique_visitors(df, "n"), "n") == [(1,), (4,)]
