"""Streaming forms of the visitor operators.

Input: flat rows with `ts` in epoch milliseconds; event_time, the watermark and the day in the session's time zone are
added here.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed
from ..functions import timefmt
from ..session import STATEFUL
from . import processors


def _timed(df: DataFrame, delay: str) -> DataFrame:
    return timefmt.with_event_time(df, "ms").withWatermark("event_time", delay)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(processors.DAY, F.unix_date(timefmt.day_of_millis("ts")).cast("long"))


def _keyed(df: DataFrame, keys: Sequence[str], processor, schema: T.StructType, event_time: str = "",
           history: DataFrame | None = None) -> DataFrame:
    for name, value in STATEFUL.items():
        df.sparkSession.conf.set(name, value)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime",
        initialState=None if history is None else history.groupBy(*keys), eventTimeColumnName=event_time)


def visits(logs: DataFrame, key: str = "mid") -> DataFrame:
    """(key, day): what fix_is_new knows of each device after a batch of rows; a device that first says '0' was here before."""
    rows = _dated(logs.where(F.col(key).isNotNull() & F.col("ts").isNotNull()))
    first = rows.groupBy(key).agg(F.min(F.struct("ts", "is_new", processors.DAY)).alias("_first"))
    return first.select(key, (F.col(f"_first.{processors.DAY}") - F.when(F.col("_first.is_new") == "1", 0).otherwise(1)).alias("day"))


def last_days(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, day, at): what daily_first knows of each key after a batch of rows: its last day and the first time on it."""
    days = _dated(rows).groupBy(*keys, F.col(processors.DAY).alias("day")).agg(F.min("ts").alias("at"))
    return days.groupBy(*keys).agg(F.max(F.struct("day", "at")).alias("_last")).select(*keys, "_last.day", "_last.at")


def fix_is_new(logs: DataFrame, key: str = "mid", delay: str = fixed.DELAY_LONG, history: DataFrame | None = None) -> DataFrame:
    """Rows with is_new corrected per device. history: `visits` of the rows before the stream.

    Only rows that say '1' can change. The others come out as they are; for the state, the earliest of
    them per device, day and task batch are enough, without their content. Rows without key or time stay as they are.
    """
    dated = F.col(key).isNotNull() & F.col("ts").isNotNull()
    says_new = F.coalesce(F.col("is_new") == "1", F.lit(False)) & dated
    slim = logs.where(dated).select(
        *[F.col(c) if c in (key, "ts") else F.when(says_new, F.col(c)).alias(c) for c in logs.columns], says_new.alias("says_new"))
    marked, day = _dated(slim), processors.DAY

    def lighten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            signs = frame[~frame["says_new"]].sort_values("ts", kind="stable").drop_duplicates([key, day])
            yield pd.concat([frame[frame["says_new"]], signs.assign(is_new="0")])

    timed = _timed(marked.mapInPandas(lighten, marked.schema), delay)
    corrected = _keyed(timed, [key], processors.FixIsNew(), timed.schema, history=history).where("says_new").select(*logs.columns)
    return logs.where(~says_new).unionByName(corrected)


def precombine(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop, before the shuffle, rows that cannot be the first of their key and day.

    Works batch by batch inside each task, so a key with a large share of the stream sends on a few
    rows per task instead of all of them.
    """
    names, day = list(keys), processors.DAY

    def least(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values("ts", kind="stable").drop_duplicates([*names, day]).drop(columns=day)

    return _dated(df).mapInPandas(least, df.schema)


def daily_first(df: DataFrame, keys: Sequence[str], delay: str = fixed.DELAY_LONG, ttl_ms: int | None = None,
                keep_all: bool = False, history: DataFrame | None = None) -> DataFrame:
    """First row per key and day with previous_day (days since 1970, -1: none) and is_first. history: `last_days` of the
    rows before the stream.

    The result keeps event_time as its time column, so that a window aggregation can follow.
    """
    rows = df if keep_all else precombine(df, keys)
    return daily_first_timed(_timed(rows, delay), keys, ttl_ms, keep_all, history)


def daily_first_timed(timed: DataFrame, keys: Sequence[str], ttl_ms: int | None = None, keep_all: bool = False,
                      history: DataFrame | None = None) -> DataFrame:
    """The same over rows that have event_time and a watermark, as after another keyed operator."""
    fields = [f for f in timed.schema.fields if f.name != "event_time"]
    schema = T.StructType([*fields, T.StructField("event_time", T.TimestampType()),
                           T.StructField("previous_day", T.LongType()), T.StructField("is_first", T.IntegerType())])
    return _keyed(_dated(timed), keys, processors.DailyFirst(ttl_ms, keep_all), schema, "event_time", history)


def is_new_user() -> Column:
    """1 on the first day a user is seen at all, over the result of daily_first without TTL."""
    return F.when(F.col("previous_day") < 0, 1).otherwise(0)


def is_back() -> Column:
    """1 if the day before lies more than 7 days (from its midnight) back."""
    away = F.col("ts") - F.unix_millis(F.date_from_unix_date(F.col("previous_day").cast("int")).cast("timestamp"))
    return F.when((F.col("previous_day") >= 0) & (away > fixed.RETURN_AFTER_MS), 1).otherwise(0)


def unique_visitor_daily(pages: DataFrame, key: str = "mid", delay: str = fixed.DELAY_LONG) -> DataFrame:
    """First entry page per device and day; a device is forgotten a day after."""
    entries = pages.where(F.col("last_page_id").isNull())
    return daily_first(entries, [key], delay, fixed.STATE_TTL_MS)


def user_jump(pages: DataFrame, key: str = "mid", timeout_ms: int = fixed.JUMP_TIMEOUT_MS,
              delay: str = fixed.DELAY_NONE) -> DataFrame:
    schema = pages.schema
    return _keyed(_timed(pages, delay), [key], processors.UserJump(schema, timeout_ms), schema)


def first_login(pages: DataFrame, key: str = "mid", delay: str = fixed.DELAY_LONG) -> DataFrame:
    """Earliest logged-in row per device and day, emitted two seconds (event time) after its arrival."""
    logged_in = pages.where(F.col("uid").isNotNull())
    schema = logged_in.schema
    return _keyed(_dated(_timed(logged_in, delay)), [key], processors.FirstLogin(schema), schema)
