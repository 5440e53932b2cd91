"""Fact joins, dimension lookups and dimension upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims, firsts, joins
from ..sources import logs
from . import inputs
from .inputs_sql import with_inputs
from .registry import query

INFO = "i.out_trade_no, i.trade_body, i.session_id, i.province_id"


@query("join_detail_order", with_inputs("order_detail order_info", f"""
  SELECT d.*, {INFO} FROM order_detail d JOIN order_info i ON d.order_id = i.id"""))
def join_detail_order(spark, sf):
    return joins.join_detail_order(inputs.order_detail(spark, sf), inputs.order_info(spark, sf))


@query("join_order_source", with_inputs("order_info last_log", """
  SELECT i.*, l.source_id FROM order_info i LEFT JOIN last_log l ON i.session_id = l.session_id"""))
def join_order_source(spark, sf):
    return joins.join_order_source(inputs.order_info(spark, sf), inputs.order_log(spark, sf))


@query("dwd_trade_order_detail", with_inputs("orders_fact", "SELECT * FROM orders_fact"))
def dwd_trade_order_detail(spark, sf):
    return inputs.orders_fact(spark, sf)


@query("join_payment_detail", with_inputs("payments orders_fact", """
  SELECT p.*, d.course_id, d.course_name, d.user_id, d.origin_amount, d.coupon_reduce, d.final_amount, d.session_id,
         d.province_id, d.source_id
  FROM payments p LEFT JOIN orders_fact d ON p.order_id = d.order_id"""))
def join_payment_detail(spark, sf):
    return joins.join_payment_detail(
        inputs.payments(spark, sf), inputs.orders_fact(spark, sf, "order_id", *joins.PAID_COLUMNS),
        inputs.orders_fact(spark, sf, "order_id"))


@query("dwd_trade_pay_sus_detail", with_inputs("payments_fact", "SELECT * FROM payments_fact"))
def dwd_trade_pay_sus_detail(spark, sf):
    return inputs.payments_fact(spark, sf)


@query("join_register_dim", with_inputs("registers pages", """
  SELECT r.id AS user_id, r.create_time AS register_time, r.create_date AS register_date, d.channel, d.province_id,
         d.version_code, d.source_id, d.mid_id, d.brand, d.model, d.operate_system, r.ts
  FROM registers r LEFT JOIN attributes d ON r.id = d.user_id""", attributes="""
  SELECT uid AS user_id, ch AS channel, ar AS province_id, vc AS version_code, sc AS source_id, mid AS mid_id,
         ba AS brand, md AS model, os AS operate_system
  FROM pages WHERE uid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, ch DESC, ar DESC, vc DESC, sc DESC, mid DESC, ba DESC,
                             md DESC, os DESC) = 1"""))
def join_register_dim(spark, sf):
    """Without row_op_ts, which is the run time."""
    attributes = logs.extract_dim_log(inputs.pages(spark, sf))
    return joins.join_register_dim(inputs.registers(spark, sf), attributes, now=False)


@query("dim_lookup", with_inputs("order_info dim_province", """
  SELECT i.id, i.province_id, p.name AS province_name FROM order_info i LEFT JOIN dim_province p ON i.province_id = p.id"""))
def dim_lookup(spark, sf):
    orders = inputs.order_info(spark, sf).select("id", "province_id")
    return dims.dim_lookup(orders, inputs.dim_province(spark, sf), "province_id", {"name": "province_name"})


@query("dim_snowflake_3", with_inputs("order_detail dim_course dim_subject dim_category", """
  SELECT d.id, d.course_id, d.ts, c.course_name, c.subject_id, s.subject_name, s.category_id, g.category_name
  FROM order_detail d LEFT JOIN dim_course c ON d.course_id = c.id LEFT JOIN dim_subject s ON c.subject_id = s.id
  LEFT JOIN dim_category g ON s.category_id = g.id"""))
def dim_snowflake_3(spark, sf):
    lines = inputs.order_detail(spark, sf).select("id", "course_id", "ts")
    return dims.dim_snowflake_3(
        lines, inputs.dim_course(spark, sf), inputs.dim_subject(spark, sf), inputs.dim_category(spark, sf))


@query("dim_chain_2", with_inputs("videos dim_video dim_chapter", """
  SELECT v.event_id, v.video_id, d.chapter_id, c.chapter_name
  FROM videos v LEFT JOIN dim_video d ON v.video_id = d.id LEFT JOIN dim_chapter c ON d.chapter_id = c.id"""))
def dim_chain_2(spark, sf):
    plays = inputs.events(spark, sf).where(F.col("event_type") == "click").select(
        "event_id", inputs.text("k").alias("video_id"))
    return dims.dim_chain_2(plays, inputs.dim_video(spark, sf), inputs.dim_chapter(spark, sf))


@query("dim_two_keys", with_inputs("pages dim_source dim_province", """
  SELECT p.event_id, p.sc AS source_id, p.ar AS province_id, s.source_site AS source_name, d.name AS province_name
  FROM pages p LEFT JOIN dim_source s ON p.sc = s.id LEFT JOIN dim_province d ON p.ar = d.id"""))
def dim_two_keys(spark, sf):
    rows = inputs.pages(spark, sf).select(
        "event_id", F.col("common.sc").alias("source_id"), F.col("common.ar").alias("province_id"))
    return dims.dim_two_keys(rows, inputs.dim_source(spark, sf), inputs.dim_province(spark, sf))


@query("dic_lookup", """
  SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS dic_code, n_name AS dic_name
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def dic_lookup(spark, sf):
    customers = inputs.table(spark, sf, "customer").select("c_custkey", inputs.text("c_nationkey").alias("dic_code"))
    return dims.dic_lookup(customers, inputs.dim_dictionary(spark, sf), "dic_code")


DIM_STATE = """
  SELECT id, max_by(level, (ts, event_id)) FILTER (level IS NOT NULL) AS level,
         max_by(score, (ts, event_id)) FILTER (score IS NOT NULL) AS score
  FROM (SELECT *, max(CASE WHEN type = 'delete' THEN (ts, event_id) END) OVER (PARTITION BY id) AS deleted FROM user_changes)
  WHERE type <> 'delete' AND (deleted IS NULL OR (ts, event_id) > deleted)
  GROUP BY id"""


@query("dim_upsert", with_inputs("user_changes", DIM_STATE))
def dim_upsert(spark, sf):
    return dims.dim_upsert(inputs.user_dim_changes(spark, sf), "id", ["id", "level", "score"], ["ts", "event_id"])


@query("latest_per_key", with_inputs("last_detail", "SELECT * FROM last_detail"))
def latest_per_key(spark, sf):
    """What an upsert sink holds: the last row per line id."""
    lines = inputs.order_detail(spark, sf)
    return firsts.latest_version(lines, ["id"], ["ts"], joins.DETAIL_IDENTITY, lines.columns)
