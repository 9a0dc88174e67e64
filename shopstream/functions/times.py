"""Time conversions. All read and write in the session time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the text columns.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def time_of_ms(ms: Column) -> Column:
    """Timestamp of epoch milliseconds."""
    return F.timestamp_millis(ms)


def second_of_ms(ms: Column) -> Column:
    """Timestamp of epoch milliseconds, cut to the second."""
    return F.date_trunc("second", F.timestamp_millis(ms))


def parse_time(text: Column) -> Column:
    """Timestamp of date or date-time text; null when it is neither."""
    return text.try_cast("timestamp")


def to_ts(text: Column) -> Column:
    """Epoch milliseconds of date or date-time text."""
    return F.unix_millis(parse_time(text))


def to_date_text(ms: Column) -> Column:
    return F.date_format(time_of_ms(ms), DATE_FORMAT)


def to_time_text(ms: Column) -> Column:
    return F.date_format(time_of_ms(ms), TIME_FORMAT)


def date_text(text: Column) -> Column:
    """Reformat date-time text as a date; null when it does not parse."""
    return F.date_format(parse_time(text), DATE_FORMAT)


def date_part(text: Column) -> Column:
    """The part of date-time text before the first blank."""
    return F.substring_index(text, " ", 1)


def day_number(time: Column) -> Column:
    """A day as the number yyyyMMdd."""
    return F.date_format(time, "yyyyMMdd").cast("int")


def on_day(time: Column, day: date | str) -> Column:
    """Filter on one day, written as a range so that file statistics can skip."""
    start = F.lit(str(day)).cast("date")
    return (time >= start.cast("timestamp")) & (time < F.date_add(start, 1).cast("timestamp"))


def compare_times(left: Column, right: Column) -> Column:
    """-1, 0 or 1 by the instants two texts name; ``.040Z`` equals ``.04Z``."""
    a, b = parse_time(left), parse_time(right)
    return F.when(a < b, -1).when(a > b, 1).when(a == b, 0)


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())
