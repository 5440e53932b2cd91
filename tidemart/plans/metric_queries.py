"""The metric tables (A1 to A16) and the window operators they rest on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from ..functions import text, timefmt
from ..operators import metrics, visitors, windows
from ..sources import logs
from . import inputs
from .inputs_sql import bounds, window_start, with_inputs
from .registry import query
from .visitor_queries import LOGIN_UV_BACK, LOGINS, TIE

def metric_sql(names: str, rows: str, keys: str, measures: dict[str, str], size_ms: int = 10_000, cur_date: bool = True,
               unit: str = "ms", dims: str = "", columns: str = "", **extra: str) -> str:
    """Window sums over `rows`; `columns` and `dims` add dimension names after the sums."""
    ms = "ts" if unit == "ms" else "ts * 1000"
    sums = ", ".join(f"CAST(sum({m}) AS {kind}) AS {m}" for m, kind in measures.items())
    key_list = f", {keys}" if keys else ""
    picked = "".join(f", m.{m}" for m in measures) + (columns and f", {columns}")
    summed = f"SELECT {window_start(ms, size_ms)} AS w{key_list}, {sums} FROM ({rows}) GROUP BY 1{key_list}"
    return with_inputs(names, f"SELECT {bounds(size_ms, cur_date, 'm.w')}{picked} FROM summed m {dims}",
                       **extra, summed=summed)


def big(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "BIGINT")


# A1, T1 ---------------------------------------------------------------------------------------------
WORDS = r"unnest(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'))"


@query("dws_keyword", with_inputs("searches", f"""
  SELECT {bounds(10_000)}, 'SEARCH' AS source, keyword, count(*) AS keyword_count
  FROM (SELECT {window_start('ts', 10_000)} AS w, {WORDS.format('item')} AS keyword FROM searches)
  WHERE keyword <> '' GROUP BY w, keyword"""))
def dws_keyword(spark, sf):
    return metrics.keyword(inputs.searches(spark, sf))


@query("tokenize_explode", f"""
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, {WORDS.format('text')} AS word FROM documents)
  WHERE word <> '' GROUP BY doc_id, word""")
def tokenize_explode(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    return text.tokenize_explode(docs, "text", "word").groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("tumble_tvf", r"""
  SELECT strftime(make_timestamp(w * 1000), '%Y-%m-%d %H:%M:%S') AS stt,
         strftime(make_timestamp((w + 86400000) * 1000), '%Y-%m-%d %H:%M:%S') AS edt,
         strftime(make_timestamp(w * 1000), '%Y-%m-%d') AS cur_date, event_type, count(*) AS n
  FROM (SELECT epoch_us(ts) // 86400000000 * 86400000 AS w, event_type FROM events) GROUP BY w, event_type""")
def tumble_tvf(spark, sf):
    rows = timefmt.with_event_time(inputs.events(spark, sf), "ms")
    return windows.tumble_tvf(rows, ["event_type"], "n", "1 day")


# A2, U1 ---------------------------------------------------------------------------------------------
TRAFFIC = {
    "visited": """SELECT * FROM pages WHERE last_page_id IS NULL
                  QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, event_id) = 1""",
    "jumped": """SELECT * FROM (SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_entry
                                FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
                 WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_entry OR next_ts - ts >= 10000)""",
    "traffic_rows": """
      SELECT ts, vc, sc, ar, is_new, 0 AS uv_count, CAST(last_page_id IS NULL AS INTEGER) AS total_session_count,
             1 AS page_view_count, during_time AS total_during_time, 0 AS jump_session_count FROM pages
      UNION ALL SELECT ts, vc, sc, ar, is_new, 1, 0, 0, 0, 0 FROM visited
      UNION ALL SELECT ts, vc, sc, ar, is_new, 0, 0, 0, 0, 1 FROM jumped""",
}


@query("union_streams", with_inputs("pages", """
  SELECT ts, vc AS version_code, sc AS source_id, ar AS province_id, is_new, uv_count, total_session_count,
         page_view_count, total_during_time, jump_session_count FROM traffic_rows""", **TRAFFIC))
def union_streams(spark, sf):
    pages = inputs.pages(spark, sf)
    rows = metrics.traffic_rows(pages, visitors.unique_visitor_daily(pages, TIE), visitors.user_jump(pages, TIE))
    return rows.withColumn("ts", F.unix_millis("event_time")).drop("event_time")


# Window lengths: the one of the job, and longer ones in which the sparse given events really meet.
TEN_SECONDS = ("", 10_000, "10 seconds")
FIVE_SECONDS = ("", 5_000, "5 seconds")
HOUR = ("_1h", 3_600_000, "1 hour")
DAY = ("_1d", 86_400_000, "1 day")


def each_size(key: str, sql: Callable[[int], str], run: Callable, *sizes: tuple[str, int, str]) -> None:
    """Register a metric once per window length."""
    for suffix, size_ms, size in sizes or (TEN_SECONDS, DAY):
        query(key + suffix, sql(size_ms))(lambda spark, sf, size=size: run(spark, sf, size))


each_size(
    "dws_traffic_vc_source_province_new",
    lambda ms: metric_sql(
        "pages dim_source dim_province", "SELECT * FROM traffic_rows", "vc, sc, ar, is_new", big(*metrics.TRAFFIC_MEASURES), ms,
        columns="m.vc AS version_code, m.is_new, s.source_site AS source_name, p.name AS province_name",
        dims="LEFT JOIN dim_source s ON m.sc = s.id LEFT JOIN dim_province p ON m.ar = p.id", **TRAFFIC),
    lambda spark, sf, size: metrics.traffic(
        inputs.pages(spark, sf), inputs.dim_source(spark, sf), inputs.dim_province(spark, sf), TIE, size))


# A3, A4 ---------------------------------------------------------------------------------------------
PAGE_FIRSTS = """
  SELECT min(ts) AS ts, CAST(page_id = 'home' AS INTEGER) AS home_uv_count,
         CAST(page_id = 'course_list' AS INTEGER) AS list_uv_count,
         CAST(page_id = 'course_detail' AS INTEGER) AS detail_uv_count
  FROM pages WHERE page_id IN ('home', 'course_list', 'course_detail') GROUP BY mid, page_id, ts // 86400000"""

each_size(
    "dws_page_view",
    lambda ms: metric_sql("pages", PAGE_FIRSTS, "", big(*metrics.PAGE_MEASURES), ms),
    lambda spark, sf, size: metrics.page_view(inputs.pages(spark, sf), size=size), TEN_SECONDS, HOUR)

each_size(
    "dws_chapter_play",
    lambda ms: metric_sql(
        "videos dim_video dim_chapter",
        """SELECT ts, video_id, 1 AS play_count, play_sec AS play_total_sec, 0 AS play_uu_count FROM videos
           UNION ALL SELECT min(ts), video_id, 0, 0, 1 FROM videos WHERE uid IS NOT NULL
           GROUP BY uid, video_id, ts // 86400000""",
        "video_id", big("play_count", "play_total_sec", "play_uu_count"), ms, cur_date=False,
        columns="m.video_id, v.chapter_id, c.chapter_name",
        dims="LEFT JOIN dim_video v ON m.video_id = v.id LEFT JOIN dim_chapter c ON v.chapter_id = c.id"),
    lambda spark, sf, size: metrics.chapter_play(
        logs.flatten_play(inputs.videos(spark, sf)), inputs.dim_video(spark, sf), inputs.dim_chapter(spark, sf), size=size))


# A5, A6 ---------------------------------------------------------------------------------------------
each_size(
    "dws_user_login",
    lambda ms: metric_sql("pages", LOGIN_UV_BACK, "", big("uv_count", "back_count"), ms, logins=LOGINS),
    lambda spark, sf, size: metrics.user_login(visitors.first_login(inputs.pages(spark, sf), TIE), size))

each_size(
    "dws_user_register",
    lambda ms: metric_sql("registers", "SELECT ts, 1 AS register_count FROM registers", "", big("register_count"), ms,
                          unit="s", cur_date=False),
    lambda spark, sf, size: metrics.user_register(inputs.registers(spark, sf), size))


# A7 to A9 -------------------------------------------------------------------------------------------
each_size(
    "dws_cart_add",
    lambda ms: metric_sql(
        "ev", "SELECT min(ts_s) AS ts, 1 AS cart_add_uv_count FROM ev WHERE event_type = 'click' GROUP BY user_id, day",
        "", big("cart_add_uv_count"), ms, unit="s"),
    lambda spark, sf, size: metrics.cart_add(inputs.carts_of(inputs.events(spark, sf)), size), TEN_SECONDS, HOUR)


def users_sql(source: str, uv: str, new: str, size_ms: int, keep: str = "TRUE") -> str:
    return metric_sql(source, f"""
      SELECT min(ts) AS ts, 1 AS {uv},
             CAST(ts // 86400 = min(min(ts // 86400)) OVER (PARTITION BY user_id) AS INTEGER) AS {new}
      FROM {source} WHERE {keep} GROUP BY user_id, ts // 86400""", "", big(uv, new), size_ms, unit="s")


each_size(
    "dws_order_users",
    lambda ms: users_sql("orders_fact", "order_uv_count", "new_order_user_count", ms, "user_id IS NOT NULL"),
    lambda spark, sf, size: metrics.order_users(inputs.orders_fact(spark, sf, "user_id", "ts"), size))

each_size(
    "dws_pay_users",
    lambda ms: users_sql("payments_fact", "pay_suc_uv_count", "pay_suc_new_user_count", ms, "user_id IS NOT NULL"),
    lambda spark, sf, size: metrics.pay_users(inputs.payments_fact(spark, sf, "user_id", "ts"), size))


# A10 to A12 -----------------------------------------------------------------------------------------
each_size(
    "dws_course_orders",
    lambda ms: metric_sql(
        "orders_fact dim_course dim_subject dim_category",
        "SELECT ts, course_id, final_amount AS order_total_amount FROM orders_fact", "course_id",
        {"order_total_amount": "DECIMAL(38,2)"}, ms, unit="s",
        columns="m.course_id, c.course_name, c.subject_id, s.subject_name, s.category_id, g.category_name",
        dims="""LEFT JOIN dim_course c ON m.course_id = c.id LEFT JOIN dim_subject s ON c.subject_id = s.id
                LEFT JOIN dim_category g ON s.category_id = g.id"""),
    lambda spark, sf, size: metrics.course_orders(
        inputs.orders_fact(spark, sf, "course_id", "final_amount", "ts"), inputs.dim_course(spark, sf), inputs.dim_subject(spark, sf),
        inputs.dim_category(spark, sf), size))


GROUPED = ("order_id", "user_id", "final_amount", "ts")


def group_sql(group: str, dim: str, column: str, name: str, size_ms: int) -> str:
    rows = f"""
      SELECT ts, {group}, final_amount AS order_total_amount, 0 AS order_uu_count, 0 AS order_count FROM lines
      UNION ALL SELECT ts, {group}, 0, 0, 1 FROM (
        SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY order_id, ts // 86400 ORDER BY ts, id) = 1)
      UNION ALL SELECT min(ts), {group}, 0, 1, 0 FROM lines GROUP BY user_id, {group}, ts // 86400"""
    return metric_sql(
        f"orders_fact {dim}", rows, group,
        {"order_total_amount": "DECIMAL(38,2)", "order_uu_count": "BIGINT", "order_count": "BIGINT"}, size_ms, unit="s",
        columns=f"m.{group}, d.{column} AS {name}", dims=f"LEFT JOIN {dim} d ON m.{group} = d.id",
        lines=f"SELECT * FROM orders_fact WHERE user_id IS NOT NULL AND {group} IS NOT NULL")


each_size(
    "dws_source_orders",
    lambda ms: group_sql("source_id", "dim_source", "source_site", "source_name", ms),
    lambda spark, sf, size: metrics.source_orders(inputs.orders_fact(spark, sf, *GROUPED, "source_id"), inputs.dim_source(spark, sf), size))

each_size(
    "dws_province_orders",
    lambda ms: group_sql("province_id", "dim_province", "name", "province_name", ms),
    lambda spark, sf, size: metrics.province_orders(inputs.orders_fact(spark, sf, *GROUPED, "province_id"), inputs.dim_province(spark, sf), size),
    FIVE_SECONDS, DAY)


# A13 to A16 -----------------------------------------------------------------------------------------
def review_sql(size_ms: int) -> str:
    return metric_sql(
        "ev dim_course",
        """SELECT ts_s AS ts, CAST(k AS VARCHAR) AS course_id, k % 5 + 1 AS review_total_stars, 1 AS review_user_count,
                  CAST(k % 5 + 1 = 5 AS INTEGER) AS good_review_user_count FROM ev""",
        "course_id", big(*metrics.REVIEW_MEASURES), size_ms, unit="s", columns="m.course_id, c.course_name",
        dims="LEFT JOIN dim_course c ON m.course_id = c.id")


each_size(
    "dws_course_review", review_sql,
    lambda spark, sf, size: metrics.course_review(
        inputs.reviews_of(inputs.events(spark, sf)), inputs.dim_course(spark, sf), size))

each_size(
    "dws_exam_paper",
    lambda ms: metric_sql(
        "ev dim_paper dim_course",
        """SELECT ts_s AS ts, CAST(user_id % 10 AS VARCHAR) AS paper_id, 1 AS exam_taken_count,
                  CAST(floor(value) AS BIGINT) AS exam_total_score, k * 10 AS exam_total_during_sec FROM ev""",
        "paper_id", big(*metrics.PAPER_MEASURES), ms, unit="s",
        columns="m.paper_id, p.paper_title, p.course_id, c.course_name",
        dims="LEFT JOIN dim_paper p ON m.paper_id = p.id LEFT JOIN dim_course c ON p.course_id = c.id"),
    lambda spark, sf, size: metrics.exam_paper(
        inputs.exams_of(inputs.events(spark, sf)), inputs.dim_paper(spark, sf), inputs.dim_course(spark, sf), size))

SCORE_SQL = """CASE WHEN value < 60 THEN '[0,60)' WHEN value < 70 THEN '[60,70)' WHEN value < 80 THEN '[70,80)'
               WHEN value < 90 THEN '[80,90)' WHEN value <= 100 THEN '[90,100]' ELSE '' END"""

each_size(
    "dws_exam_score",
    lambda ms: metric_sql(
        "ev dim_paper",
        f"SELECT ts_s AS ts, CAST(user_id % 10 AS VARCHAR) AS paper_id, {SCORE_SQL} AS score_duration, 1 AS user_count FROM ev",
        "paper_id, score_duration", big("user_count"), ms, unit="s",
        columns="m.paper_id, m.score_duration, p.paper_title", dims="LEFT JOIN dim_paper p ON m.paper_id = p.id"),
    lambda spark, sf, size: metrics.exam_score(inputs.exams_of(inputs.events(spark, sf)), inputs.dim_paper(spark, sf), size))

each_size(
    "dws_exam_question",
    lambda ms: metric_sql(
        "ev dim_question",
        """SELECT ts_s AS ts, CAST(k AS VARCHAR) AS question_id, 1 AS answer_count, event_id % 2 AS correct_answer_count
           FROM ev""",
        "question_id", big(*metrics.QUESTION_MEASURES), ms, unit="s", columns="m.question_id, q.question_txt",
        dims="LEFT JOIN dim_question q ON m.question_id = q.id"),
    lambda spark, sf, size: metrics.exam_question(
        inputs.answers_of(inputs.events(spark, sf)), inputs.dim_question(spark, sf), size))


# W4, W5, W8 -----------------------------------------------------------------------------------------
EVENT_ROWS = "SELECT ts, event_type, 1 AS n, k AS k_sum FROM ev"


@query("tumble_keyed", metric_sql("ev", EVENT_ROWS, "event_type", big("n", "k_sum"), columns="m.event_type"))
def tumble_keyed(spark, sf):
    rows = timefmt.with_event_time(inputs.events(spark, sf), "ms").select(
        "event_time", "event_type", F.lit(1).alias("n"), F.col("k").alias("k_sum"))
    return windows.windowed_metric(rows, ["event_type"], ["n", "k_sum"])


@query("tumble_global", metric_sql("ev", EVENT_ROWS, "", big("n", "k_sum"), 5_000))
def tumble_global(spark, sf):
    rows = timefmt.with_event_time(inputs.events(spark, sf), "ms").select(
        "event_time", F.lit(1).alias("n"), F.col("k").alias("k_sum"))
    return windows.windowed_metric(rows, [], ["n", "k_sum"], "5 seconds")


@query("window_bounds", with_inputs("ev", f"""
  SELECT event_id, {bounds(10_000)} FROM (SELECT event_id, {window_start('ts', 10_000)} AS w FROM ev)"""))
def window_bounds(spark, sf):
    rows = timefmt.with_event_time(inputs.events(spark, sf), "ms")
    return windows.window_bounds(rows.select(F.window("event_time", "10 seconds").alias("window"), "event_id"))
