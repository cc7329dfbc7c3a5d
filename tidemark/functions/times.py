"""Epoch conversion and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def millis_to_timestamp(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp with millisecond precision."""
    return F.timestamp_millis(millis.cast("bigint"))


def millis_to_second(millis: Column) -> Column:
    """Epoch milliseconds to whole seconds; the division drops the remainder."""
    return F.timestamp_seconds(F.call_function("div", millis.cast("bigint"), F.lit(1000)))


def to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def weekday(ts: Column, base: int = 0) -> Column:
    """Day of the week with Sunday as ``base`` (0 or 1)."""
    if base not in (0, 1):
        raise ValueError("base is 0 or 1")
    return F.dayofweek(ts) if base == 1 else F.dayofweek(ts) - F.lit(1)


def calendar_parts(ts: Column, weekday_base: int = 0) -> list[Column]:
    """hour, day, ISO week, month, year and weekday, as columns of those names."""
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekday(ts, weekday_base).alias("weekday"),
    ]
