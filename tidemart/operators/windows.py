"""Tumbling and session windows over event_time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed
from ..functions import timefmt


def tumble(df: DataFrame, aggregates: Sequence[Column], keys: Sequence[str] = (),
           size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Tumbling window per key, or over all rows without keys; partial sums form before the shuffle."""
    return df.groupBy(F.window("event_time", size).alias("window"), *keys).agg(*aggregates)


def window_bounds(df: DataFrame, cur_date: bool = True) -> DataFrame:
    """Window start, end and date as text, in place of the window."""
    start, end = F.col("window.start"), F.col("window.end")
    texts = [F.date_format(start, timefmt.DATETIME).alias("stt"), F.date_format(end, timefmt.DATETIME).alias("edt")]
    if cur_date:
        texts.append(F.date_format(start, timefmt.DATE).alias("cur_date"))
    return df.select(*texts, *[c for c in df.columns if c != "window"])


def windowed_metric(df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str],
                    size: str = fixed.METRIC_WINDOW, cur_date: bool = True) -> DataFrame:
    """Window sums of measures per key. A mapping gives the type of each sum."""
    types = measures if isinstance(measures, Mapping) else {m: "bigint" for m in measures}
    sums = [F.sum(m).cast(kind).alias(m) for m, kind in types.items()]
    return window_bounds(tumble(df, sums, keys, size), cur_date)


def tumble_tvf(df: DataFrame, keys: Sequence[str], count: str, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """The same window in SQL: row counts per key."""
    names = ", ".join(keys)
    counted = df.sparkSession.sql(
        f"select window, {names}, count(*) as {count} from {{rows}} "
        f"group by window(event_time, '{size}'), {names}", rows=df)
    return window_bounds(counted)


def session_stream(plays: DataFrame, gap: str = fixed.SESSION_GAP) -> DataFrame:
    """Play sessions by Spark's session window; this form also runs on streams."""
    windowed = plays.groupBy("session_id", F.session_window("event_time", gap)).agg(*_session_parts(plays))
    return _session_row(windowed, plays)


def session_keyed(plays: DataFrame, gap_ms: int = 3_000, slice_ms: int = 600_000) -> DataFrame:
    """Play sessions of a batch: sum of seconds, last position, other columns from the first row.

    A session id may hold a large share of all rows, so sessions form in two steps: first within a
    slice of time, then the pieces of one session id are put together. Pieces of one id are at least a
    gap apart or end at a slice border, so their number is bounded by the time span, not by the rows.
    A distance of exactly the gap still belongs to the session, as with the session window itself.
    """
    sliced = plays.withColumn("_slice", F.floor(F.col("ts") / slice_ms))
    pieces = sliced.groupBy("session_id", "_slice", F.session_window("event_time", f"{gap_ms} milliseconds")).agg(
        F.min("ts").alias("_from"), F.max("ts").alias("_to"), *_session_parts(plays))

    order = Window.partitionBy("session_id").orderBy("_from")
    opens = F.when(F.col("_from") - F.lag("_to").over(order) <= gap_ms, 0).otherwise(1)
    numbered = pieces.withColumn("_opens", opens).withColumn(
        "_session", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = numbered.groupBy("session_id", "_session").agg(
        F.sum("_play_sec").alias("_play_sec"), F.max("_last").alias("_last"), F.min("_first").alias("_first"))
    return _session_row(whole, plays)


def _first_columns(plays: DataFrame) -> list[str]:
    return [c for c in plays.columns if c not in ("ts", "session_id", "event_time", "play_sec", "position_sec")]


def _session_parts(plays: DataFrame) -> list[Column]:
    return [F.sum("play_sec").alias("_play_sec"), F.max(F.struct("ts", "position_sec")).alias("_last"),
            F.min(F.struct("ts", *_first_columns(plays))).alias("_first")]


def _session_row(df: DataFrame, plays: DataFrame) -> DataFrame:
    return df.select(
        "session_id", "_first.ts", *[f"_first.{c}" for c in _first_columns(plays)],
        F.col("_play_sec").alias("play_sec"), F.col("_last.position_sec").alias("position_sec"))


def watermarked(df: DataFrame, delay: str) -> DataFrame:
    """Bound the lateness of a stream: bounded ('5 seconds', '3 seconds') or ascending ('0 seconds')."""
    return df.withWatermark("event_time", delay)
