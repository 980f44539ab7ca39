"""Event time, lateness and latency. Times are bigint microseconds since the epoch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def parsed_stamp_us(stamp: Column) -> Column:
    """ISO-8601 text to microseconds, null when it is missing or no full timestamp."""
    return F.when(stamp.rlike(r"^\d{4}-\d{2}-\d{2}"), F.unix_micros(stamp.try_cast("timestamp")))


def bucket_start_us(time_us: Column, width_sec: int) -> Column:
    """Start of the epoch-aligned bucket; correct before 1970 too."""
    return time_us - F.pmod(time_us, F.lit(width_sec * MICROS))


def window_start_s(time_us: Column, width_sec: int) -> Column:
    """The same bucket in whole seconds, as bigint."""
    return (bucket_start_us(time_us, width_sec) / F.lit(MICROS)).cast("bigint")


def latency_us() -> Column:
    """Receive minus event time; negative for stamps from the future."""
    return F.col("receive_us") - F.col("event_us")


def is_late(window_sec: int, max_lag_sec: int) -> Column:
    """Late: the event's bucket had closed when it arrived, and it lagged more than allowed."""
    bucket = bucket_start_us(F.col("event_us"), window_sec)
    now_bucket = bucket_start_us(F.col("receive_us"), window_sec)
    closed = bucket < now_bucket - F.lit(window_sec * MICROS)
    return closed & (latency_us() > F.lit(max_lag_sec * MICROS))


def iso_utc(seconds: Column) -> Column:
    """ISO text of whole epoch seconds; expects session time zone UTC."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def iso_utc_micros(time_us: Column) -> Column:
    """ISO text with six fraction digits; expects session time zone UTC."""
    return F.date_format(F.timestamp_micros(time_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
