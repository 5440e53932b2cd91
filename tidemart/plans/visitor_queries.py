"""Keyed operators over page logs and trade facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import timefmt
from ..operators import filters, firsts, metrics, visitors, windows
from ..sources import logs
from . import inputs
from .inputs_sql import day, stamp, with_inputs
from .registry import query

TIE = ("event_id",)

FIX_IS_NEW = with_inputs("pages", """
  SELECT event_id, mid, ts,
         CASE WHEN is_new = '1' AND visit_day <> ts // 86400000 THEN '0' ELSE is_new END AS is_new
  FROM (SELECT *, first_value(ts // 86400000) OVER w
                  - CASE WHEN first_value(is_new) OVER w = '1' THEN 0 ELSE 1 END AS visit_day
        FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))""")


@query("fix_is_new", FIX_IS_NEW)
def fix_is_new(spark, sf):
    fixed_log = visitors.fix_is_new(inputs.pages(spark, sf), TIE)
    return fixed_log.select("event_id", "common.mid", "ts", "common.is_new")


UNIQUE_VISITOR = with_inputs("pages", """
  SELECT event_id, mid, ts, ar, page_id FROM pages WHERE last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, event_id) = 1""")


@query("unique_visitor_daily", UNIQUE_VISITOR)
def unique_visitor_daily(spark, sf):
    rows = visitors.unique_visitor_daily(inputs.pages(spark, sf), TIE)
    return rows.select("event_id", "common.mid", "ts", "common.ar", "page.page_id")


def _jump_sql(timeout_ms: int) -> str:
    return with_inputs("pages", f"""
      SELECT event_id, mid, ts, page_id
      FROM (SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_entry
            FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
      WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_entry OR next_ts - ts >= {timeout_ms})""")


def _jump(spark, sf, timeout_ms):
    rows = visitors.user_jump(inputs.pages(spark, sf), TIE, timeout_ms)
    return rows.select("event_id", "common.mid", "ts", "page.page_id")


@query("user_jump", _jump_sql(10_000))
def user_jump(spark, sf):
    return _jump(spark, sf, 10_000)


@query("user_jump_10m", _jump_sql(600_000))
def user_jump_10m(spark, sf):
    return _jump(spark, sf, 600_000)


@query("user_jump_1d", _jump_sql(86_400_000))
def user_jump_1d(spark, sf):
    return _jump(spark, sf, 86_400_000)


FIRST_LOGIN = with_inputs("pages", f"""
  SELECT uid AS user_id, sc AS source_id, ch AS channel, ar AS province_id, vc AS version_code, mid AS mid_id,
         ba AS brand, md AS model, os AS operating_system, {stamp('ts')} AS login_time, {day('ts')} AS date_id, ts
  FROM pages WHERE uid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, event_id) = 1""")


@query("first_login", FIRST_LOGIN)
def first_login(spark, sf):
    return visitors.first_login(inputs.pages(spark, sf), TIE)


def flag_sql(source: str, keys: str, order: str, flag: str, columns: str, day_ms: str = "ts") -> str:
    return with_inputs(source, f"""
      SELECT {columns}, CAST(row_number() OVER (PARTITION BY {keys}, {day_ms} // 86400000 ORDER BY {order}) = 1
             AS INTEGER) AS {flag}
      FROM {source}""")


@query("play_user_daily", flag_sql("videos", "uid, video_id", "ts, event_id", "play_uu_count",
                                   "event_id, uid AS user_id, video_id, ts, play_sec"))
def play_user_daily(spark, sf):
    plays = inputs.events(spark, sf).where(F.col("event_type") == "click").select(
        "event_id", inputs.common()["uid"].alias("user_id"), inputs.text("k").alias("video_id"), "ts",
        F.floor("value").cast("int").alias("play_sec"))
    return firsts.flag_daily_first(plays, ["user_id", "video_id"], "play_uu_count", ["ts", "event_id"])


@query("cart_user_daily", with_inputs("ev", """
  SELECT event_id AS id, user_id, CAST(k AS BIGINT) AS course_id, ts_s AS ts
  FROM ev WHERE event_type = 'click'
  QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts_s, event_id) = 1"""))
def cart_user_daily(spark, sf):
    carts = inputs.carts_of(inputs.events(spark, sf))
    return firsts.daily_first(carts, ["user_id"], ["ts", "id"], "s").select("id", "user_id", "course_id", "ts")


def user_new_sql(source: str, keep: str = "TRUE") -> str:
    return with_inputs(source, f"""
      SELECT user_id, min(ts) AS ts, 1 AS uv_count,
             CAST(ts // 86400 = min(min(ts // 86400)) OVER (PARTITION BY user_id) AS INTEGER) AS new_count
      FROM {source} WHERE {keep} GROUP BY user_id, ts // 86400""")


@query("order_user_daily_new", user_new_sql("orders_fact"))
def order_user_daily_new(spark, sf):
    return visitors.user_daily_new(inputs.orders_fact(spark, sf, "user_id", "ts"))


@query("pay_user_daily_new", user_new_sql("payments_fact", "user_id IS NOT NULL"))
def pay_user_daily_new(spark, sf):
    return visitors.user_daily_new(filters.filter_required_keys(inputs.payments_fact(spark, sf, "user_id", "ts"), "user_id"))


@query("order_daily_flag", flag_sql("orders_fact", "order_id", "ts, id", "order_count",
                                    "id, order_id, ts, final_amount", "ts * 1000"))
def order_daily_flag(spark, sf):
    lines = inputs.orders_fact(spark, sf, "id", "order_id", "ts", "final_amount")
    return firsts.flag_daily_first(lines, ["order_id"], "order_count", ["ts", "id"], "s")


@query("user_group_daily_flag", with_inputs("orders_fact", """
  SELECT id, user_id, province_id, ts,
         CAST(row_number() OVER (PARTITION BY user_id, province_id, ts // 86400 ORDER BY ts, id) = 1 AS INTEGER)
           AS order_uu_count
  FROM orders_fact WHERE user_id IS NOT NULL AND province_id IS NOT NULL"""))
def user_group_daily_flag(spark, sf):
    lines = filters.filter_required_keys(
        inputs.orders_fact(spark, sf, "id", "user_id", "province_id", "ts"), "user_id", "province_id")
    return firsts.flag_daily_first(lines, ["user_id", "province_id"], "order_uu_count", ["ts", "id"], "s")


PAGE_DAILY = """
  SELECT mid, {page} page_id, {start} AS ts, CAST({page} = 'home' AS INTEGER) AS home_uv_count,
         CAST({page} = 'course_list' AS INTEGER) AS list_uv_count, CAST({page} = 'course_detail' AS INTEGER) AS detail_uv_count
  FROM pages WHERE page_id IN ('home', 'course_list', 'course_detail')"""


def _millis(df):
    return df.withColumn("ts", F.unix_millis("event_time")).drop("event_time")


@query("page_daily_uv", with_inputs("pages", PAGE_DAILY.format(page="page_id", start="min(ts)").replace(
    "page_id page_id", "page_id") + " GROUP BY mid, page_id, ts // 86400000"))
def page_daily_uv(spark, sf):
    return _millis(metrics.page_daily_uv(inputs.pages(spark, sf)))


@query("page_daily_uv_by_device", with_inputs("pages", """
  SELECT mid, ts, CAST(page_id = 'home' AS INTEGER) AS home_uv_count,
         CAST(page_id = 'course_list' AS INTEGER) AS list_uv_count,
         CAST(page_id = 'course_detail' AS INTEGER) AS detail_uv_count
  FROM pages WHERE page_id IN ('home', 'course_list', 'course_detail')
  QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, page_id) = 1"""))
def page_daily_uv_by_device(spark, sf):
    return _millis(metrics.page_daily_uv(inputs.pages(spark, sf), ("mid",)))


LOGINS = """SELECT uid AS user_id, ts FROM pages WHERE uid IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, event_id) = 1"""
LOGIN_UV_BACK = """
  SELECT user_id, min(ts) AS ts, 1 AS uv_count,
         CAST(coalesce(min(ts) - 86400000 * lag(ts // 86400000) OVER (PARTITION BY user_id ORDER BY ts // 86400000)
              > 604800000, FALSE) AS INTEGER) AS back_count
  FROM logins GROUP BY user_id, ts // 86400000"""


@query("login_uv_back", with_inputs("pages", LOGIN_UV_BACK, logins=LOGINS))
def login_uv_back(spark, sf):
    return visitors.login_uv_back(visitors.first_login(inputs.pages(spark, sf), TIE))


PLAY_COLUMNS = """sid AS session_id, sc AS source_id, ar AS province_id, uid AS user_id, os AS operating_system,
  ch AS channel, is_new, md AS model, mid AS machine_id, vc AS version_code, ba AS brand, video_id"""


def session_sql(gap_ms: int) -> str:
    return with_inputs("videos", f"""
      SELECT {PLAY_COLUMNS}, ts, CAST(sum_sec AS BIGINT) AS play_sec, last_position AS position_sec
      FROM (SELECT *, sum(play_sec) OVER (PARTITION BY sid, session) AS sum_sec,
                   first_value(position_sec) OVER (PARTITION BY sid, session ORDER BY ts DESC, position_sec DESC) AS last_position
            FROM (SELECT *, sum(opens) OVER (PARTITION BY sid ORDER BY ts, event_id) AS session
                  FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY sid ORDER BY ts, event_id) <= {gap_ms}
                                       THEN 0 ELSE 1 END AS opens FROM videos)))
      QUALIFY row_number() OVER (PARTITION BY sid, session ORDER BY ts) = 1""")


def _plays(spark, sf):
    return timefmt.with_event_time(logs.flatten_play(inputs.videos(spark, sf)), "ms")


@query("session_keyed", session_sql(1_800_000))
def session_keyed(spark, sf):
    """Session windows with a gap of half an hour."""
    return windows.session_keyed(_plays(spark, sf), 1_800_000)


@query("dwd_study_play", session_sql(3_000))
def dwd_study_play(spark, sf):
    return windows.session_keyed(_plays(spark, sf), 3_000)


@query("dwd_study_play_6h", session_sql(6 * 3_600_000))
def dwd_study_play_6h(spark, sf):
    """With a gap of six hours, which joins plays of the given events."""
    return windows.session_keyed(_plays(spark, sf), 6 * 3_600_000)
