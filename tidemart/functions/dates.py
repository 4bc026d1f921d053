"""Epoch, date and day-range columns.

All of them assume a UTC session (``tidemart.session.prepare``); other zones are
given by ``tz``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FULL = "yyyy-MM-dd HH:mm:ss"
DAY_MS = 24 * 60 * 60 * 1000
SECONDS_LIMIT = 10_000_000_000  # Fixed value: smaller epochs are seconds.


def wall_clock(ms: Column, tz: str = "UTC") -> Column:
    ts = F.timestamp_millis(ms)
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def datetime_to_ts(text: Column, tz: str = "+08:00") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in ``tz`` to epoch milliseconds."""
    return F.unix_millis(F.to_utc_timestamp(F.to_timestamp(text, FULL), tz))


def local_date(ms: Column, tz: str = "UTC") -> Column:
    return wall_clock(ms, tz).cast("date")


def ts_to_date(ms: Column, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd``."""
    return local_date(ms, tz).cast("string")


def ts_to_datetime(ms: Column, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(wall_clock(ms, tz), FULL)


def ts_to_partition(ms: Column, tz: str = "UTC") -> Column:
    """``yyyyMMdd``."""
    return F.date_format(wall_clock(ms, tz), "yyyyMMdd")


def date_to_ts(text: Column, tz: str = "+08:00") -> Column:
    """midnight of ``yyyy-MM-dd`` in ``tz``."""
    return datetime_to_ts(F.concat(text, F.lit(" 00:00:00")), tz)


def format_date(ts: Column, pattern: str = FULL) -> Column:
    """F8."""
    return F.date_format(ts, pattern)


def day_range(start: Column, end: Column) -> Column:
    """the days between two dates, inclusive, as ``yyyyMMdd`` integers."""
    days = F.transform(
        F.sequence(start, F.greatest(start, end)),
        lambda d: F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d),
    )
    return F.when(start <= end, days).when(start > end, F.array().cast("array<int>"))


def event_timestamp(ms: Column) -> Column:
    """F10."""
    return F.timestamp_millis(ms)


def normalise_epoch(x: Column) -> Column:
    """epoch seconds become milliseconds, milliseconds stay; missing is 0."""
    x = F.coalesce(x.cast("bigint"), F.lit(0))
    return F.when(x < SECONDS_LIMIT, x * 1000).otherwise(x)


def day_bucket(x: Column, tz: str = "UTC") -> Column:
    """the name of the day folder."""
    return F.concat(F.lit("day="), ts_to_partition(normalise_epoch(x), tz))


def yesterday(ms: Column, tz: str = "UTC") -> Column:
    """the date 24 hours before."""
    return ts_to_date(ms - F.lit(DAY_MS), tz)
