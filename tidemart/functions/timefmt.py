"""Time conversions between epoch numbers and text, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
COMPACT_DATE = "yyyyMMdd"


def datetime_to_millis(text) -> Column:
    return F.unix_timestamp(text, DATETIME) * 1000


def date_to_millis(text) -> Column:
    return F.unix_timestamp(text, DATE) * 1000


def millis_to_date(ts) -> Column:
    return F.date_format(F.timestamp_millis(ts), DATE)


def millis_to_datetime(ts) -> Column:
    return F.date_format(F.timestamp_millis(ts), DATETIME)


def millis_to_compact_date(ts) -> Column:
    return F.date_format(F.timestamp_millis(ts), COMPACT_DATE)


def day_of_millis(ts) -> Column:
    """Calendar day as DATE: four bytes as a grouping key instead of ten characters."""
    return F.to_date(F.timestamp_millis(ts))


def with_event_time(df: DataFrame, unit: str, ts: str = "ts") -> DataFrame:
    """Add event_time from an epoch column; unit is 'ms' (logs) or 's' (change records)."""
    to_time = {"ms": F.timestamp_millis, "s": F.timestamp_seconds}[unit]
    return df.withColumn("event_time", to_time(F.col(ts)))
