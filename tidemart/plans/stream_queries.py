"""Structured Streaming forms, run over the whole events table until its rows are used up.

A stream only closes windows that its watermark has passed, so the SQL leaves the last ones out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import timefmt
from ..operators import dims, metrics, windows
from ..session import shared_folder
from ..sources import logs
from ..streaming import joins, runs, stateful
from . import inputs
from .inputs_sql import bounds, window_start, with_inputs
from .metric_queries import big, metric_sql, review_sql
from .registry import query
from .visitor_queries import PLAY_COLUMNS


def finished(spark, rows: DataFrame) -> DataFrame:
    """The complete output of a stream."""
    path = shared_folder(spark, "stream")
    runs.to_files(rows, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


def closed(sql: str, size_ms: int, delay_ms: int, source: str = "ev") -> str:
    """Keep the windows of a metric_sql text that end before the last watermark."""
    return sql + f" WHERE m.w + {size_ms} <= (SELECT max(ts) - {delay_ms} FROM {source})"


COUNTS = "SELECT ts, event_type, 1 AS n FROM ev"
COUNTED = metric_sql("ev", COUNTS, "event_type", big("n"), columns="m.event_type")


def _counted(spark, sf, delay):
    rows = timefmt.with_event_time(inputs.events_stream(spark, sf), "ms").select(
        "event_time", "event_type", F.lit(1).alias("n"))
    return finished(spark, windows.windowed_metric(windows.watermarked(rows, delay), ["event_type"], ["n"]))


@query("watermark_bounded", closed(COUNTED, 10_000, 5_000))
def watermark_bounded(spark, sf):
    return _counted(spark, sf, "5 seconds")


@query("watermark_ascending", closed(COUNTED, 10_000, 0))
def watermark_ascending(spark, sf):
    return _counted(spark, sf, "0 seconds")


@query("watermark_sql", closed(metric_sql("ev", COUNTS, "event_type", big("n"), 60_000, columns="m.event_type"), 60_000, 3_000))
def watermark_sql(spark, sf):
    """The window as SQL over a stream with a time column computed from the epoch number."""
    rows = inputs.events_stream(spark, sf).selectExpr("event_type", "timestamp_millis(ts) as event_time")
    return finished(spark, windows.tumble_tvf(rows.withWatermark("event_time", "3 seconds"), ["event_type"], "n", "1 minute"))


@query("stream_course_review", closed(review_sql(10_000), 10_000, 5_000, "(SELECT ts_s * 1000 AS ts FROM ev)"))
def stream_course_review(spark, sf):
    """Window sums of a stream, then a stream-static dimension lookup."""
    rows = metrics.review_rows(inputs.reviews_of(inputs.events_stream(spark, sf)))
    summed = windows.windowed_metric(windows.watermarked(rows, "5 seconds"), ["course_id"], metrics.REVIEW_MEASURES)
    return finished(spark, dims.dim_lookup(summed, inputs.dim_course(spark, sf), "course_id", {"course_name": "course_name"}))


STREAM_GAP_MS = 6 * 3_600_000
STREAM_SESSIONS = with_inputs("videos", f"""
  SELECT {PLAY_COLUMNS}, ts, CAST(sum_sec AS BIGINT) AS play_sec, last_position AS position_sec
  FROM (SELECT *, sum(play_sec) OVER (PARTITION BY sid, session) AS sum_sec,
               first_value(position_sec) OVER (PARTITION BY sid, session ORDER BY ts DESC, position_sec DESC) AS last_position,
               max(ts) OVER (PARTITION BY sid, session) AS last_ts
        FROM (SELECT *, sum(opens) OVER (PARTITION BY sid ORDER BY ts, event_id) AS session
              FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY sid ORDER BY ts, event_id) <= {STREAM_GAP_MS}
                                   THEN 0 ELSE 1 END AS opens FROM videos)))
  WHERE last_ts + {STREAM_GAP_MS} <= (SELECT max(ts) - 5000 FROM videos)
  QUALIFY row_number() OVER (PARTITION BY sid, session ORDER BY ts) = 1""")


@query("stream_session", STREAM_SESSIONS)
def stream_session(spark, sf):
    """Sessions of a stream by Spark's session window, gap six hours."""
    plays = timefmt.with_event_time(logs.flatten_play(inputs.videos_of(inputs.events_stream(spark, sf))), "ms")
    return finished(spark, windows.session_stream(windows.watermarked(plays, "5 seconds"), f"{STREAM_GAP_MS} milliseconds"))


@query("late_drop", with_inputs("ev", f"""
  SELECT {bounds(10_000)}, n FROM (
    SELECT {window_start('ts', 10_000)} AS w, count(*) AS n FROM ev
    WHERE ts >= (SELECT (min(ts) + max(ts)) // 2 FROM ev) GROUP BY 1)
  WHERE w + 10000 <= (SELECT max(ts) - 5000 FROM ev)"""))
def late_drop(spark, sf):
    """The second half of the time comes first, so that the first half is late and drops out."""
    path = shared_folder(spark, "late")
    rows = inputs.events(spark, sf).select("ts")
    ends = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    half = F.col("ts") >= (ends.low + ends.high) // 2
    for part in (half, ~half):
        rows.where(part).write.mode("append").parquet(f"{path}/in")
        timed = timefmt.with_event_time(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), "ms").select(
            "event_time", F.lit(1).alias("n"))
        counted = windows.windowed_metric(windows.watermarked(timed, "5 seconds"), [], ["n"])
        # The same checkpoint both times: the second run goes on with the state and watermark of the first.
        runs.to_files(counted, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{path}/rows")


def _flat_pages(spark, sf) -> DataFrame:
    pages = inputs.pages_of(inputs.events_stream(spark, sf))
    return pages.select("event_id", "common.mid", "common.uid", "common.is_new", "page.page_id", "page.last_page_id", "ts")


@query("stream_fix_is_new", with_inputs("pages", """
  SELECT event_id, mid, ts,
         CASE WHEN is_new = '1' AND visit_day <> ts // 86400000 THEN '0' ELSE is_new END AS is_new
  FROM (SELECT *, first_value(ts // 86400000) OVER w
                  - CASE WHEN first_value(is_new) OVER w = '1' THEN 0 ELSE 1 END AS visit_day
        FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))"""))
def stream_fix_is_new(spark, sf):
    return finished(spark, stateful.fix_is_new(_flat_pages(spark, sf)).select("event_id", "mid", "ts", "is_new"))


def _halves(spark, sf, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first half of the time as a table, the second as a stream."""
    ends = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    later, path = F.col("ts") >= ((ends.low or 0) + (ends.high or 0)) // 2, shared_folder(spark, "half")
    rows.where(later).write.parquet(path)
    return rows.where(~later), spark.readStream.schema(rows.schema).parquet(path)


@query("stream_fix_is_new_resumed", with_inputs("pages", """
  SELECT event_id, mid, ts,
         CASE WHEN is_new = '1' AND visit_day <> ts // 86400000 THEN '0' ELSE is_new END AS is_new
  FROM (SELECT *, first_value(ts // 86400000) OVER w
                  - CASE WHEN first_value(is_new) OVER w = '1' THEN 0 ELSE 1 END AS visit_day
        FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
  WHERE ts >= (SELECT (min(ts) + max(ts)) // 2 FROM pages)"""))
def stream_fix_is_new_resumed(spark, sf):
    """A stream that starts in the middle, its state filled by a batch query over the rows before."""
    pages = inputs.pages(spark, sf).select("event_id", "common.mid", "common.is_new", "ts")
    before, after = _halves(spark, sf, pages)
    fixed_rows = stateful.fix_is_new(after, history=stateful.visits(before))
    return finished(spark, fixed_rows.select("event_id", "mid", "ts", "is_new"))


@query("stream_new_users_resumed", with_inputs("ev", """
  SELECT event_id, user_id, ts, CASE WHEN before IS NULL THEN 1 ELSE 0 END AS is_new_user FROM (
    SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM (
      SELECT * FROM ev WHERE event_type = 'click'
      QUALIFY row_number() OVER (PARTITION BY user_id, ts // 86400000 ORDER BY ts, event_id) = 1))
  WHERE ts >= (SELECT (min(ts) + max(ts)) // 2 FROM ev WHERE event_type = 'click')"""))
def stream_new_users_resumed(spark, sf):
    """Daily first clicks of the second half, and whether the user was never seen in either half."""
    clicks = inputs.events(spark, sf).where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    before, after = _halves(spark, sf, clicks)
    first = stateful.daily_first(after, ["user_id"], history=stateful.last_days(before, ["user_id"]))
    return finished(spark, first.select("event_id", "user_id", "ts", stateful.is_new_user().alias("is_new_user")))


@query("stream_unique_visitor", with_inputs("pages", """
  SELECT event_id, mid, page_id, ts FROM pages WHERE last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, event_id) = 1"""))
def stream_unique_visitor(spark, sf):
    """Daily unique visitors."""
    return finished(spark, stateful.unique_visitor_daily(_flat_pages(spark, sf)).select("event_id", "mid", "page_id", "ts"))


DAY_MS = 86_400_000


@query("state_ttl", with_inputs("pages", f"""
  SELECT event_id, mid, ts,
         CASE WHEN last_ts IS NULL OR ts >= half AND last_ts < half AND last_ts + {DAY_MS} <= passed THEN -1
              ELSE last_ts // {DAY_MS} END AS previous_day
  FROM (SELECT *, lag(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS last_ts FROM (
          SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY mid, ts // {DAY_MS} ORDER BY ts, event_id) = 1)),
       (SELECT half, max(ts) - 5000 AS passed FROM entries, (SELECT (min(ts) + max(ts)) // 2 AS half FROM entries)
        WHERE ts < half GROUP BY half)""", entries="SELECT event_id, mid, ts FROM pages WHERE last_page_id IS NULL"))
def state_ttl(spark, sf):
    """First entry per device and day with the day before it that the state knows. The two halves of the time are two
    runs of one stream: between them the state of devices that were away for a day is forgotten."""
    path = shared_folder(spark, "ttl")
    rows = inputs.pages(spark, sf).where(F.col("page.last_page_id").isNull()).select("event_id", "common.mid", "ts")
    ends = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    half = F.col("ts") >= (ends.low + ends.high) // 2
    for part in (~half, half):
        rows.where(part).write.mode("append").parquet(f"{path}/in")
        timed = windows.watermarked(timefmt.with_event_time(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), "ms"), "5 seconds")
        first = stateful.daily_first_timed(timed, ["mid"], DAY_MS).select("event_id", "mid", "ts", "previous_day")
        runs.to_files(first, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(first.schema).parquet(f"{path}/rows")


@query("stream_user_jump", with_inputs("pages", """
  SELECT event_id, mid, page_id, ts
  FROM (SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_entry
        FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
  WHERE last_page_id IS NULL AND (next_entry OR next_ts - ts >= 10000
        OR next_ts IS NULL AND ts + 10000 <= (SELECT max(ts) FROM pages))"""))
def stream_user_jump(spark, sf):
    """An entry page at the very end of the stream still waits for its timer."""
    return finished(spark, stateful.user_jump(_flat_pages(spark, sf)).select("event_id", "mid", "page_id", "ts"))


@query("event_timer", with_inputs("pages", """
  SELECT event_id, mid, uid, ts FROM pages WHERE uid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, event_id) = 1
      AND ts + 2000 <= max(max(ts)) OVER () - 5000""".replace("max(max(ts)) OVER ()", "(SELECT max(ts) FROM pages WHERE uid IS NOT NULL)")))
def event_timer(spark, sf):
    """First logins, emitted by an event-time timer."""
    return finished(spark, stateful.first_login(_flat_pages(spark, sf)).select("event_id", "mid", "uid", "ts"))


@query("stream_cart_add", closed(metric_sql(
    "ev", "SELECT min(ts) AS ts, 1 AS cart_add_uv_count FROM ev WHERE event_type = 'click' GROUP BY user_id, day",
    "", big("cart_add_uv_count")), 10_000, 3_000, "(SELECT ts FROM ev WHERE event_type = 'click')"))
def stream_cart_add(spark, sf):
    """Daily-first state chained into a window."""
    carts = inputs.events_stream(spark, sf).where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    first = stateful.daily_first(carts, ["user_id"], "3 seconds", 86_400_000)
    rows = first.select("event_time", F.lit(1).alias("cart_add_uv_count"))
    return finished(spark, windows.windowed_metric(rows, [], ["cart_add_uv_count"]))


NEAR_MS = 2 * 86_400_000


@query("join_state_ttl", with_inputs("ev", f"""
  SELECT s.event_id, s.user_id, max_by(c.event_id, (c.ts, c.event_id)) AS click_id, s.ts
  FROM (SELECT * FROM ev WHERE event_type = 'signup') s
  LEFT JOIN (SELECT * FROM ev WHERE event_type = 'click') c
    ON s.user_id = c.user_id AND c.ts BETWEEN s.ts - {NEAR_MS} AND s.ts + {NEAR_MS}
  WHERE s.ts + {NEAR_MS} < (
    SELECT least(max(ts) FILTER (event_type = 'signup'), max(ts) FILTER (event_type = 'click')) - 5000 FROM ev)
  GROUP BY s.event_id, s.user_id, s.ts"""))
def join_state_ttl(spark, sf):
    """Signups with the last click of the same user at most two days off; the bound empties the join state."""
    def side(kind, **names):
        rows = inputs.events_stream(spark, sf).where(F.col("event_type") == kind)
        timed = windows.watermarked(timefmt.with_event_time(rows, "ms"), "5 seconds")
        return timed.select("event_time", "user_id", *[F.col(c).alias(n) for n, c in names.items()])

    signups = side("signup", event_id="event_id", ts="ts")
    joined = joins.bounded_join(signups, side("click", click_id="event_id", _ts="ts"), "user_id", "leftOuter", "2 days")
    last = joins.last_partner(joined, signups.columns, ["click_id"], ["_ts", "click_id"])
    return finished(spark, last.select("event_id", "user_id", "click_id", "ts"))
