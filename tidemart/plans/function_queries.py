"""Scalar functions over whole tables."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from ..functions import jsontext, measures, names, segment, timefmt
from . import inputs
from .inputs_sql import with_inputs
from .registry import query


@query("fn_json_fields", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, props->>'$.k' AS k_text FROM events")
def fn_json_fields(spark, sf):
    """JSON text to typed fields."""
    rows = jsontext.parse(inputs.table(spark, sf, "events"), "k int", "props")
    return rows.select("event_id", "rec.k", jsontext.get_text("props", "$.k").alias("k_text"))


@query("fn_to_json", """
  SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def fn_to_json(spark, sf):
    """row to JSON text."""
    return inputs.table(spark, sf, "events").select(jsontext.record(["event_id", "event_type"]).alias("value"))


@query("fn_map_get", with_inputs("event_changes", "SELECT id, course_id, CAST(NULL AS VARCHAR) AS missing FROM event_changes"))
def fn_map_get(spark, sf):
    """map elements, null where the key is missing."""
    data = F.col("data")
    return inputs.event_changes(spark, sf).select(
        data["id"].alias("id"), data["course_id"].alias("course_id"), data["missing"].alias("missing"))


@query("fn_time_to_millis", """
  SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS datetime_ms, epoch_us(o_orderdate) // 1000 AS date_ms FROM orders""")
def fn_time_to_millis(spark, sf):
    """date and datetime text to epoch milliseconds."""
    at = F.col("o_orderdate").cast("timestamp")
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", timefmt.datetime_to_millis(F.date_format(at, timefmt.DATETIME)).alias("datetime_ms"),
        timefmt.date_to_millis(F.date_format(at, timefmt.DATE)).alias("date_ms"))


@query("fn_millis_to_text", """
  SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime_text,
         strftime(ts, '%Y%m%d') AS compact_text FROM events""")
def fn_millis_to_text(spark, sf):
    """epoch milliseconds to date and datetime text."""
    return inputs.events(spark, sf).select(
        "event_id", timefmt.millis_to_date("ts").alias("date_text"),
        timefmt.millis_to_datetime("ts").alias("datetime_text"), timefmt.millis_to_compact_date("ts").alias("compact_text"))


@query("fn_sql_time", with_inputs("ev", """
  SELECT event_id, strftime(make_timestamp(ts_s * 1000000), '%Y-%m-%d %H:%M:%S') AS from_seconds, day, ts_s AS back_s FROM ev"""))
def fn_sql_time(spark, sf):
    """the time functions as SQL expressions."""
    return inputs.events(spark, sf).selectExpr(
        "event_id", "from_unixtime(ts_s, 'yyyy-MM-dd HH:mm:ss') as from_seconds",
        "date_format(to_timestamp(from_unixtime(ts_s)), 'yyyy-MM-dd') as day",
        "unix_timestamp(timestamp_seconds(ts_s)) as back_s")


@query("fn_row_time", """
  SELECT event_id, TRUE AS is_now, TRUE AS one_time, TRUE AS same_millis FROM events""")
def fn_row_time(spark, sf):
    """F8: the run time per row. Its value is not fixed, but what holds of it is: it lies between the call and an hour
    later, all rows share it, and both of its forms agree."""
    called = int(time.time() * 1000)
    rows = inputs.events(spark, sf).select(
        "event_id", F.current_timestamp().alias("row_op_ts"), F.unix_millis(F.current_timestamp()).alias("now_ms"))
    ends = rows.agg(F.min("row_op_ts").alias("least"), F.max("row_op_ts").alias("most"))
    return rows.join(ends, F.col("row_op_ts") == F.col("least"), "left").select(
        "event_id", F.col("now_ms").between(called, called + 3_600_000).alias("is_now"),
        F.coalesce(F.col("least") == F.col("most"), F.lit(False)).alias("one_time"),
        (F.unix_millis("row_op_ts") == F.col("now_ms")).alias("same_millis"))


@query("fn_text_parts", """
  SELECT c_custkey, substring(c_name, 1, 8) AS head, string_split(c_name, '#')[2] AS number,
         list_contains(string_split(c_name, '#'), 'Customer') AS has_word, c_mktsegment || '-' || c_nationkey AS joined
  FROM customer""")
def fn_text_parts(spark, sf):
    """Substring, split list with membership, concatenated key."""
    parts = F.split("c_name", "#")
    return inputs.table(spark, sf, "customer").select(
        "c_custkey", F.substring("c_name", 1, 8).alias("head"), parts[1].alias("number"),
        F.array_contains(parts, "Customer").alias("has_word"),
        F.concat_ws("-", "c_mktsegment", "c_nationkey").alias("joined"))


@query("fn_decimal", """
  SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount,
         count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def fn_decimal(spark, sf):
    """exact sums of decimal amounts."""
    amount = inputs.cents("l_extendedprice") + inputs.cents("l_tax")
    return inputs.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(amount).cast(measures.SUM).alias("amount"), F.count("*").alias("n"))


@query("fn_names", "SELECT c_custkey AS cust_key, c_mktsegment AS market_segment FROM customer")
def fn_names(spark, sf):
    """camelCase columns to snake_case."""
    rows = inputs.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custKey"), F.col("c_mktsegment").alias("marketSegment"))
    return names.snake_columns(rows)

# The names of three parts in a row, without spaces, and the paths through their lattice.
NAMES = """
  SELECT p_partkey, name || next_name || after AS name FROM (
    SELECT p_partkey, replace(p_name, ' ', '') AS name,
           coalesce(lead(replace(p_name, ' ', ''), 1) OVER (ORDER BY p_partkey), '') AS next_name,
           coalesce(lead(replace(p_name, ' ', ''), 2) OVER (ORDER BY p_partkey), '') AS after
    FROM part)"""
SEGMENTED = f"""
  WITH RECURSIVE names AS ({NAMES}), dictionary AS (
    SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part
    UNION SELECT DISTINCT replace(p_name, ' ', '') FROM part WHERE p_partkey % 3 = 0
    UNION SELECT DISTINCT right(replace(p_name, ' ', ''), 5) FROM part WHERE p_partkey % 5 = 0),
  texts AS (SELECT DISTINCT name FROM names),
  paths AS (
    SELECT name, 1 AS pos, CAST([] AS VARCHAR[]) AS words, CAST([] AS INTEGER[]) AS sizes FROM texts
    UNION ALL
    SELECT p.name, p.pos + len(s.step), list_append(p.words, s.step), list_append(p.sizes, CAST(len(s.step) AS INTEGER))
    FROM paths p JOIN LATERAL (
      SELECT word AS step FROM dictionary WHERE word = substring(p.name, p.pos, len(word))
      UNION ALL
      SELECT substring(p.name, p.pos, 1) WHERE NOT EXISTS (
        SELECT 1 FROM dictionary WHERE word = substring(p.name, p.pos, len(word)))) s ON true
    WHERE p.pos <= len(p.name)),
  best AS (
    SELECT name, words FROM paths WHERE pos > len(name)
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY len(words), sizes DESC) = 1)
  SELECT n.p_partkey, array_to_string(b.words, ' ') AS words FROM names n JOIN best b ON n.name = b.name"""


def _unspaced(spark, sf):
    parts = inputs.table(spark, sf, "part")
    flat = parts.select("p_partkey", F.regexp_replace("p_name", " ", "").alias("n"))
    later = [flat.select((F.col("p_partkey") - i).alias("p_partkey"), F.col("n").alias(f"n{i}")) for i in (1, 2)]
    three = flat.join(later[0], "p_partkey", "left").join(later[1], "p_partkey", "left")
    entries = parts.select(F.explode(F.split("p_name", " ")).alias("word")).unionByName(
        flat.where("p_partkey % 3 = 0").select(F.col("n").alias("word"))).unionByName(
        flat.where("p_partkey % 5 = 0").select(F.expr("right(n, 5)").alias("word")))
    return three.select("p_partkey", F.concat("n", F.coalesce("n1", F.lit("")), F.coalesce("n2", F.lit(""))).alias("name")), entries


@query("segment_words", SEGMENTED)
def segment_words(spark, sf):
    """Words of unspaced names by a dictionary with overlapping words."""
    names, entries = _unspaced(spark, sf)
    cut = segment.segmenter(spark, segment.dictionary(entries))
    # Characters that no word covers come out as one word; the SQL has them one by one.
    return names.select("p_partkey", F.concat_ws(" ", cut(F.col("name"))).alias("words"))


@query("segment_lateral", f"""
  SELECT keyword, count(*) AS n FROM (SELECT unnest(string_split(words, ' ')) AS keyword FROM ({SEGMENTED})) GROUP BY keyword""")
def segment_lateral(spark, sf):
    """The same as a table function in SQL, counted by word."""
    names, entries = _unspaced(spark, sf)
    segment.register(spark, "segment_text", segment.dictionary(entries))
    names.createOrReplaceTempView("unspaced_names")
    return spark.sql("SELECT keyword, count(*) AS n FROM unspaced_names, LATERAL segment_text(name) GROUP BY keyword")
