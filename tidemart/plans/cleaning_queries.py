"""Sources, cleaning, routing, splitting and flat projections."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import jsontext, measures
from ..operators import filters, routing, splitting
from ..sources import cdc, config, logs, readers
from . import inputs
from .inputs_sql import day, stamp, with_inputs
from .registry import query

# S1 to S5 -------------------------------------------------------------------------------------------


@query("read_cdc_envelope", with_inputs("event_changes", f"""
  SELECT "database", "table", type, ts, id, user_id, course_id, extra, {stamp('ts * 1000')} AS event_time
  FROM event_changes"""))
def read_cdc_envelope(spark, sf):
    rows = cdc.read_cdc_envelope(inputs.as_topic(inputs.event_changes(spark, sf)))
    return rows.select("database", "table", "type", "ts", *cdc.fields("id", "user_id", "course_id", "extra"),
                       F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"))


def _page_topic(spark, sf):
    return jsontext.with_once(inputs.pages(spark, sf), "value", jsontext.record(["common", "page", "ts"])).select("value")


@query("read_page_log", with_inputs("pages", "SELECT mid, uid, sid, sc, page_id, last_page_id, during_time, ts FROM pages"))
def read_page_log(spark, sf):
    return logs.read_page_log(_page_topic(spark, sf)).select(
        "common.mid", "common.uid", "common.sid", "common.sc", "page.page_id", "page.last_page_id", "page.during_time", "ts")


@query("read_page_log_maps", with_inputs("pages", """
  SELECT mid, uid, page_id, CAST(during_time AS VARCHAR) AS during_time, ts FROM pages"""))
def read_page_log_maps(spark, sf):
    rows = logs.read_page_log(_page_topic(spark, sf), maps=True)
    common, page = F.col("common"), F.col("page")
    return rows.select(common["mid"].alias("mid"), common["uid"].alias("uid"), page["page_id"].alias("page_id"),
                       page["during_time"].alias("during_time"), "ts")


@query("drop_tombstones", with_inputs("ev", "SELECT event_id FROM ev WHERE k NOT IN (97, 98)"))
def drop_tombstones(spark, sf):
    return readers.drop_tombstones(inputs.log_topic(spark, sf)).select("event_id")


@query("parse_tolerant", with_inputs("logs", """
  SELECT mid, ts, CASE WHEN on_page THEN page_id END AS page_id FROM logs"""))
def parse_tolerant(spark, sf):
    return logs.read_page_log(inputs.log_topic(spark, sf)).select("common.mid", "ts", "page.page_id")


@query("config_latest", with_inputs("config_rows", """
  SELECT source_table, sink_table, sink_columns, op, ts_ms
  FROM (SELECT * FROM config_rows
        QUALIFY row_number() OVER (PARTITION BY source_table ORDER BY ts_ms DESC, event_id DESC) = 1)
  WHERE op <> 'd'"""))
def config_latest(spark, sf):
    rows = config.cdc_before_after(inputs.config_changes(spark, sf))
    return config.config_latest(rows, order=("ts_ms", "event_id")).drop("event_id")


# P1 to P4 -------------------------------------------------------------------------------------------
TYPES = "('insert', 'update', 'delete', 'bootstrap-insert')"


@query("cdc_clean_dim", with_inputs("event_changes", f"""
  SELECT "table", type, ts, id, user_id FROM event_changes WHERE "database" = 'edu' AND type IN {TYPES} AND k % 8 <> 0"""))
def cdc_clean_dim(spark, sf):
    return cdc.cdc_clean_dim(inputs.event_changes(spark, sf)).select("table", "type", "ts", *cdc.fields("id", "user_id"))


@query("cdc_clean_fact", with_inputs("event_changes", """
  SELECT "table", type, ts, id, user_id FROM event_changes WHERE "database" = 'edu' AND type = 'insert' AND k % 8 <> 0"""))
def cdc_clean_fact(spark, sf):
    return cdc.cdc_clean_fact(inputs.event_changes(spark, sf)).select("table", "type", "ts", *cdc.fields("id", "user_id"))


@query("split_dirty", with_inputs("ev", """
  SELECT substring('{"common":{"sc":"4","ar":"24","uid":"' || user_id || '","os":"os1"', 1, 40) AS value
  FROM ev WHERE k = 99"""))
def split_dirty(spark, sf):
    return logs.split_dirty(inputs.log_topic(spark, sf))[1]


@query("cdc_before_after", with_inputs("config_rows", "SELECT * FROM config_rows"))
def cdc_before_after(spark, sf):
    return config.cdc_before_after(inputs.config_changes(spark, sf))


# P5 to P7 -------------------------------------------------------------------------------------------
FACT_CONFIG = [
    # source table, row type, sink table, columns, op, ts_ms
    ("cart_info", "insert", "dwd_trade_cart_old", "id", "r", 1),
    ("cart_info", "insert", "dwd_trade_cart_add", "id,user_id,course_id", "u", 2),
    ("test_exam", "insert", "dwd_exam_test_paper", "id,extra", "c", 1),
    ("review_info", "update", "dwd_interaction_review", "id,course_id,missing", "c", 1),
    ("favor_info", "bootstrap-insert", "dwd_interaction_favor_add", "id", "r", 1),
    ("favor_info", "bootstrap-insert", "dwd_interaction_favor_add", "id", "d", 3),
]
FACT_CONFIG_SCHEMA = "source_table string, source_type string, sink_table string, sink_columns string, op string, ts_ms bigint"

DIM_CONFIG = [
    ("favor_info", "dim_favor", "id,extra", "id"), ("review_info", "dim_review", "id,user_id,course_id", "id")]
DIM_CONFIG_SCHEMA = "source_table string, sink_table string, sink_columns string, sink_row_key string"


def _local(spark, rows, schema):
    # From pandas, so that Spark knows the size of the rows and can decide on a broadcast.
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=names), schema)


def fact_config(spark):
    return config.config_latest(_local(spark, FACT_CONFIG, FACT_CONFIG_SCHEMA), config.FACT_KEY).select(
        "source_table", "source_type", "sink_table", "sink_columns")


def routed_facts(spark, sf):
    return routing.route_by_config(inputs.event_changes(spark, sf), fact_config(spark), "fact")


ROUTED = with_inputs("event_changes", """
  SELECT "table", type, "database", ts, id, user_id, course_id, extra, 'dwd_trade_cart_add' AS sink_table
    FROM event_changes WHERE "table" = 'cart_info'
  UNION ALL SELECT "table", type, "database", ts, id, user_id, course_id, extra, 'dwd_exam_test_paper'
    FROM event_changes WHERE "table" = 'test_exam'
  UNION ALL SELECT "table", type, "database", ts, id, user_id, course_id, extra, 'dwd_interaction_review'
    FROM event_changes WHERE "table" = 'review_info'""")

KEPT_COLUMNS = """id, CASE WHEN sink_table = 'dwd_trade_cart_add' THEN user_id END AS user_id,
         CASE WHEN sink_table <> 'dwd_exam_test_paper' THEN course_id END AS course_id,
         CASE WHEN sink_table = 'dwd_exam_test_paper' THEN extra END AS extra"""


@query("route_facts", ROUTED)
def route_facts(spark, sf):
    return routing.route_facts(inputs.event_changes(spark, sf), fact_config(spark)).select(
        "table", "type", "database", "ts", *cdc.fields("id", "user_id", "course_id", "extra"), "sink_table")


@query("prune_sink_columns", f"SELECT sink_table, {KEPT_COLUMNS} FROM ({ROUTED})")
def prune_sink_columns(spark, sf):
    routed = routing.route_facts(inputs.event_changes(spark, sf), fact_config(spark))
    return routing.prune_sink_columns(routed).select("sink_table", *cdc.fields("id", "user_id", "course_id", "extra"))


@query("attach_meta", with_inputs("event_changes", "SELECT id, type AS meta_type, CAST(ts AS VARCHAR) AS meta_ts FROM event_changes"))
def attach_meta(spark, sf):
    rows = inputs.event_changes(spark, sf)
    both = routing.attach_meta(routing.attach_meta(rows, "type"), "ts")
    return both.select(F.col("data")["id"].alias("id"), F.col("data")["type"].alias("meta_type"),
                       F.col("data")["ts"].alias("meta_ts"))


@query("route_by_config", f"SELECT sink_table, CAST(ts AS VARCHAR) AS ts, {KEPT_COLUMNS} FROM ({ROUTED})")
def route_by_config(spark, sf):
    return routed_facts(spark, sf).select("sink_table", *cdc.fields("ts", "id", "user_id", "course_id", "extra"))


@query("route_by_config_dim", with_inputs("event_changes", f"""
  SELECT CASE WHEN "table" = 'favor_info' THEN 'dim_favor' ELSE 'dim_review' END AS sink_table, 'id' AS sink_row_key, type, id,
         CASE WHEN "table" = 'review_info' THEN user_id END AS user_id,
         CASE WHEN "table" = 'favor_info' THEN extra END AS extra
  FROM event_changes
  WHERE "table" IN ('favor_info', 'review_info') AND "database" = 'edu' AND type IN {TYPES} AND k % 8 <> 0"""))
def route_by_config_dim(spark, sf):
    cleaned = cdc.cdc_clean_dim(inputs.event_changes(spark, sf))
    routed = routing.route_by_config(cleaned, _local(spark, DIM_CONFIG, DIM_CONFIG_SCHEMA), "dim")
    return routed.select("sink_table", "sink_row_key", *cdc.fields("type", "id", "user_id", "extra"))


# P8 to P12 ------------------------------------------------------------------------------------------
def _texts(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def _trade_topic(spark, sf, name):
    return cdc.read_cdc_envelope(inputs.as_topic(inputs.trade_changes(spark, sf)), tables=[name])


@query("extract_order_detail", with_inputs("order_detail", f"SELECT {_texts(*cdc.ORDER_DETAIL)}, create_date, ts FROM order_detail"))
def extract_order_detail(spark, sf):
    return cdc.extract_order_detail(_trade_topic(spark, sf, "order_detail"))


@query("extract_order_info", with_inputs("order_info", f"SELECT {_texts(*cdc.ORDER_INFO)}, ts FROM order_info"))
def extract_order_info(spark, sf):
    return cdc.extract_order_info(_trade_topic(spark, sf, "order_info"))


@query("extract_order_log", with_inputs("order_log", "SELECT * FROM order_log"))
def extract_order_log(spark, sf):
    return logs.extract_order_log(inputs.pages(spark, sf))


@query("extract_payment", with_inputs("payments", f"SELECT {_texts(*cdc.PAYMENT)}, create_date, ts FROM payments"))
def extract_payment(spark, sf):
    return cdc.extract_payment(_trade_topic(spark, sf, "payment_info"))


@query("extract_user_register", with_inputs("registers", "SELECT id, create_time, create_date, ts FROM registers"))
def extract_user_register(spark, sf):
    return cdc.extract_user_register(_trade_topic(spark, sf, "user_info"))


@query("extract_dim_log", with_inputs("pages", """
  SELECT uid AS user_id, ch AS channel, ar AS province_id, vc AS version_code, sc AS source_id, mid AS mid_id,
         ba AS brand, md AS model, os AS operate_system, ts
  FROM pages WHERE uid IS NOT NULL"""))
def extract_dim_log(spark, sf):
    return logs.extract_dim_log(inputs.pages(spark, sf))


# P13 to P16 -----------------------------------------------------------------------------------------
SPLIT_FIELDS = """common struct<mid:string,net:string>, ts bigint, page struct<page_id:string,during_time:bigint>,
  err struct<code:string>, start struct<entry:string>, appVideo struct<video_id:string>,
  display struct<display_type:string,item:string,pos_id:int>, action struct<action_id:string,item:string>, trace struct<id:string>"""


def _records(lines):
    return jsontext.parse(lines, SPLIT_FIELDS)


@query("split_log", with_inputs("logs", """
  SELECT event_id, 'dwd_traffic_err' AS topic, mid, ts, CASE WHEN on_page THEN page_id END AS page_id,
         CAST(k AS VARCHAR) AS err_code, CASE WHEN is_start THEN 'icon' END AS start_entry,
         CASE WHEN is_video THEN CAST(k AS VARCHAR) END AS video_id, CAST(NULL AS VARCHAR) AS shown,
         CAST(NULL AS VARCHAR) AS action
    FROM logs WHERE has_err
  UNION ALL SELECT event_id, 'dwd_traffic_start', mid, ts, NULL, NULL, 'icon', NULL, NULL, NULL FROM logs WHERE is_start
  UNION ALL SELECT event_id, 'dwd_traffic_appvideo', mid, ts, NULL, NULL, NULL, CAST(k AS VARCHAR), NULL, NULL
    FROM logs WHERE is_video
  UNION ALL SELECT event_id, 'dwd_traffic_page', mid, ts, page_id, NULL, NULL, NULL, NULL, NULL FROM logs WHERE on_page
  UNION ALL SELECT event_id, 'dwd_traffic_display', mid, ts, page_id, NULL, NULL, NULL,
                   CAST(unnest(generate_series(1, k % 4)) AS VARCHAR), NULL
    FROM logs WHERE has_displays
  UNION ALL SELECT event_id, 'dwd_traffic_action', mid, NULL, page_id, NULL, NULL, NULL, NULL, 'pay'
    FROM logs WHERE has_actions"""))
def split_log(spark, sf):
    rows = _records(splitting.split_log(inputs.log_topic(spark, sf)))
    return rows.select(
        "event_id", "topic", "rec.common.mid", "rec.ts", "rec.page.page_id", F.col("rec.err.code").alias("err_code"),
        F.col("rec.start.entry").alias("start_entry"), "rec.appVideo.video_id", F.col("rec.display.item").alias("shown"),
        F.col("rec.action.action_id").alias("action"))


@query("split_log_unknown_fields", with_inputs("logs", """
  SELECT event_id, topic, net, trace_id FROM (
    SELECT *, CASE WHEN odd THEN '5g' END AS net, CASE WHEN odd THEN 't' || k END AS trace_id
    FROM (SELECT *, event_id % 5 = 0 AS odd FROM logs))
  CROSS JOIN (VALUES ('dwd_traffic_err'), ('dwd_traffic_start'), ('dwd_traffic_appvideo'), ('dwd_traffic_page')) t(topic)
  WHERE CASE topic WHEN 'dwd_traffic_err' THEN has_err WHEN 'dwd_traffic_start' THEN is_start
             WHEN 'dwd_traffic_appvideo' THEN is_video ELSE on_page END"""))
def split_log_unknown_fields(spark, sf):
    """Fields that no schema names reach the outputs."""
    rows = _records(splitting.split_log(inputs.log_topic(spark, sf)))
    return rows.where(F.col("rec.display").isNull() & F.col("rec.action").isNull()).select(
        "event_id", "topic", "rec.common.net", F.col("rec.trace.id").alias("trace_id"))


@query("explode_displays", with_inputs("logs", """
  SELECT mid, page_id, ts, 'query' AS display_type, CAST(pos_id AS VARCHAR) AS item, CAST(pos_id AS INTEGER) AS pos_id
  FROM (SELECT *, unnest(generate_series(1, k % 4)) AS pos_id FROM logs WHERE has_displays)"""))
def explode_displays(spark, sf):
    rows = _records(splitting.explode_displays(inputs.log_topic(spark, sf)))
    return rows.select("rec.common.mid", "rec.page.page_id", "rec.ts", "rec.display.display_type", "rec.display.item",
                       "rec.display.pos_id")


@query("explode_actions", with_inputs("logs", """
  SELECT mid, page_id, 'pay' AS action_id, CAST(k AS VARCHAR) AS item FROM logs WHERE has_actions"""))
def explode_actions(spark, sf):
    rows = _records(splitting.explode_actions(inputs.log_topic(spark, sf)))
    return rows.select("rec.common.mid", "rec.page.page_id", "rec.action.action_id", "rec.action.item")


@query("page_only", with_inputs("logs", "SELECT event_id, mid, page_id, during_time, ts FROM logs WHERE on_page"))
def page_only(spark, sf):
    rows = _records(splitting.page_only(inputs.log_topic(spark, sf)))
    return rows.select("event_id", "rec.common.mid", "rec.page.page_id", "rec.page.during_time", "rec.ts")


# P17 to P24 -----------------------------------------------------------------------------------------
@query("entry_pages", with_inputs("pages", "SELECT event_id, mid, page_id, ts FROM pages WHERE last_page_id IS NULL"))
def entry_pages(spark, sf):
    return filters.entry_pages(inputs.pages(spark, sf)).select("event_id", "common.mid", "page.page_id", "ts")


@query("filter_login_pages", with_inputs("pages", "SELECT event_id, mid, uid, ts FROM pages WHERE uid IS NOT NULL"))
def filter_login_pages(spark, sf):
    return filters.filter_login_pages(inputs.pages(spark, sf)).select("event_id", "common.mid", "common.uid", "ts")


@query("filter_three_pages", with_inputs("pages", """
  SELECT event_id, mid, page_id, ts FROM pages WHERE page_id IN ('home', 'course_list', 'course_detail')"""))
def filter_three_pages(spark, sf):
    return filters.filter_three_pages(inputs.pages(spark, sf)).select("event_id", "common.mid", "page.page_id", "ts")


@query("filter_required_keys", with_inputs("orders_fact", """
  SELECT id, user_id, source_id, final_amount, ts FROM orders_fact WHERE user_id IS NOT NULL AND source_id IS NOT NULL"""))
def filter_required_keys(spark, sf):
    rows = filters.filter_required_keys(inputs.orders_fact(spark, sf), "user_id", "source_id")
    return rows.select("id", "user_id", "source_id", "final_amount", "ts")


@query("flatten_play", with_inputs("videos", """
  SELECT sc AS source_id, ar AS province_id, uid AS user_id, os AS operating_system, ch AS channel, is_new, md AS model,
         mid AS machine_id, vc AS version_code, ba AS brand, sid AS session_id, play_sec, position_sec, video_id, ts
  FROM videos"""))
def flatten_play(spark, sf):
    return logs.flatten_play(inputs.videos(spark, sf))


@query("flatten_login", with_inputs("pages", f"""
  SELECT uid AS user_id, sc AS source_id, ch AS channel, ar AS province_id, vc AS version_code, mid AS mid_id,
         ba AS brand, md AS model, os AS operating_system, {stamp('ts')} AS login_time, {day('ts')} AS date_id, ts
  FROM pages WHERE uid IS NOT NULL"""))
def flatten_login(spark, sf):
    return filters.flatten_login(filters.filter_login_pages(inputs.pages(spark, sf)))


@query("score_bucket", """
  SELECT event_id, CASE WHEN value < 60 THEN '[0,60)' WHEN value < 70 THEN '[60,70)' WHEN value < 80 THEN '[70,80)'
                        WHEN value < 90 THEN '[80,90)' WHEN value <= 100 THEN '[90,100]' ELSE '' END AS score_duration
  FROM events""")
def score_bucket(spark, sf):
    return inputs.table(spark, sf, "events").select("event_id", measures.score_bucket(F.col("value")).alias("score_duration"))


@query("indicator_columns", with_inputs("ev", """
  SELECT event_id, CAST(event_id % 2 = 1 AS INTEGER) AS correct, CAST(k % 5 + 1 = 5 AS INTEGER) AS five_star,
         CAST(event_type IN ('view', 'signup') AS INTEGER) AS session_start
  FROM ev"""))
def indicator_columns(spark, sf):
    rows = inputs.events(spark, sf)
    return rows.select(
        "event_id", measures.indicator(inputs.text(F.col("event_id") % 2) == "1").alias("correct"),
        measures.indicator(F.col("k") % 5 + 1 == 5).alias("five_star"),
        measures.indicator(inputs.page()["last_page_id"].isNull()).alias("session_start"))
