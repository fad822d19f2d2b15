"""Epoch conversions and time buckets. All are UTC by construction or under a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}

# Unix milliseconds of 0001-01-01 and of the last millisecond of 9999.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def seconds_of(bucket: str | int) -> int:
    """Bucket width in seconds, from a unit name or a number."""
    width = BUCKET_SECONDS[bucket] if isinstance(bucket, str) else bucket
    if width <= 0:
        raise ValueError(f"bucket width must be positive, got {bucket!r}")
    return width


def check_day_bucket(bucket: str | int) -> None:
    """Tables rebuilt by day need candles that do not cross midnight."""
    if BUCKET_SECONDS["day"] % seconds_of(bucket):
        raise ValueError(f"{bucket!r} does not divide a day")


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Exact: keeps milliseconds, also before 1970."""
    return F.timestamp_millis(ms)


def epoch_ms_to_timestamp_seconds(ms: Column) -> Column:
    """Whole seconds, rounded toward zero (the warehouse's lossy form)."""
    return F.timestamp_seconds(F.call_function("div", ms, F.lit(1000)))


def is_calendar_ms(ms: Column) -> Column:
    """True for epoch milliseconds that are a date in the years 1 to 9999."""
    return ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS)


def bucket_start(time: Column, bucket: str | int) -> Column:
    """Start of the fixed-width bucket a timestamp falls in.

    Plain long arithmetic: cheaper than ``date_trunc`` and free of the session zone.
    """
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds_of(bucket) * 1_000_000)))


def seconds_interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def month_number(time: Column) -> Column:
    """``202401`` for January 2024."""
    return F.year(time) * 100 + F.month(time)
