"""Sinks, written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import timefmt
from ..operators import joins, windows
from ..session import shared_folder
from ..sinks import lifecycle, tables, topics
from ..sources import config
from . import inputs
from .cleaning_queries import KEPT_COLUMNS, ROUTED, routed_facts
from .inputs_sql import with_inputs
from .join_queries import DIM_STATE
from .metric_queries import EVENT_ROWS, big, metric_sql
from .registry import query


@query("sink_routed", f"""
  SELECT sink_table, '{{"id":"' || id || '"' || coalesce(',"user_id":"' || user_id || '"', '')
         || coalesce(',"course_id":"' || course_id || '"', '') || coalesce(',"extra":"' || extra || '"', '')
         || ',"ts":"' || ts || '"}}' AS value
  FROM (SELECT sink_table, ts, {KEPT_COLUMNS} FROM ({ROUTED}))""")
def sink_routed(spark, sf):
    path = shared_folder(spark, "routed")
    topics.append(topics.routed_rows(routed_facts(spark, sf)), path, "sink_table")
    return spark.read.schema("value string, sink_table string").text(path).select("sink_table", "value")


@query("sink_append_json", with_inputs("pages", """
  SELECT '{"mid":"' || mid || '","page_id":"' || page_id || '","ts":' || ts || '}' AS value FROM pages"""))
def sink_append_json(spark, sf):
    path = shared_folder(spark, "topic")
    rows = inputs.pages(spark, sf).select("common.mid", "page.page_id", "ts")
    topics.append(topics.to_json_rows(rows), path)
    return spark.read.text(path)


@query("sink_upsert_latest", with_inputs("last_detail", "SELECT * FROM last_detail"))
def sink_upsert_latest(spark, sf):
    """Order lines in three batches of their time; the table holds the last row per line id."""
    table = tables.KeyedTable(spark, shared_folder(spark, "upsert"), ["id"], ["ts"], identity=joins.DETAIL_IDENTITY)
    lines = inputs.order_detail(spark, sf)
    for batch in range(3):
        table.write(lines.where(F.pmod("ts", F.lit(3)) == batch), batch)
    return table.read()


@query("sink_upsert_deletes", with_inputs("user_changes", """
  SELECT id, type, ts, event_id, level, score FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS n FROM user_changes)
  WHERE n = 1 AND type <> 'delete'"""))
def sink_upsert_deletes(spark, sf):
    """User changes with deletes in five batches that are not in order of time; one is written twice, as after a failure,
    and the base is folded on the way."""
    table = tables.KeyedTable(spark, shared_folder(spark, "upsert"), ["id"], ["ts", "event_id"], "type", fold_every=2)
    rows = inputs.user_dim_changes(spark, sf).select(
        F.col("data")["id"].alias("id"), "type", "ts", "event_id", F.col("data")["level"].alias("level"), F.col("data")["score"].alias("score"))
    for batch in (0, 1, 1, 2, 3, 4):
        table.write(rows.where(F.pmod("event_id", F.lit(5)) == 4 - batch), batch)
    return table.read()


@query("sink_metric_table", metric_sql("ev", EVENT_ROWS, "event_type", big("n", "k_sum"), 3_600_000, columns="m.event_type"))
def sink_metric_table(spark, sf):
    """An hourly metric; the second batch is written twice, as after a failure."""
    table = tables.MetricTable(spark, shared_folder(spark, "metric"))
    rows = timefmt.with_event_time(inputs.events(spark, sf), "ms").select(
        "event_time", "event_type", F.lit(1).alias("n"), F.col("k").alias("k_sum"))
    metric = windows.windowed_metric(rows, ["event_type"], ["n", "k_sum"], "1 hour")
    early = F.substring("stt", 12, 2) < "12"
    table.write(metric.where(early), 0)
    for _ in range(2):
        table.write(metric.where(~early), 1)
    return table.read()


@query("to_snake_json", with_inputs("ev", """
  SELECT '{"user_id":' || user_id || ',"event_type":"' || event_type || '","order_total_count":' || k || '}' AS value
  FROM ev"""))
def to_snake_json(spark, sf):
    rows = inputs.events(spark, sf).select(
        F.col("user_id").alias("userId"), F.col("event_type").alias("eventType"), F.col("k").alias("orderTotalCount"),
        F.col("day").alias("curDate"))
    return topics.to_snake_json(rows, ("curDate",))


@query("dim_upsert_batches", with_inputs("user_changes", DIM_STATE))
def dim_upsert_batches(spark, sf):
    """Dimension changes in three batches of their time; the first two are folded, the last is merged with the base."""
    store = tables.DimStore(spark, shared_folder(spark, "dim"), ["ts", "event_id"])
    changes = inputs.user_dim_changes(spark, sf).withColumn("sink_table", F.lit("dim_user"))
    ends = changes.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    columns, third = ["id", "level", "score"], ((ends.high or 0) - (ends.low or 0)) // 3 + 1
    for batch in range(3):
        store.write(changes.where(F.floor((F.col("ts") - (ends.low or 0)) / third) == batch), batch)
        if batch == 1:
            store.fold("dim_user", "id", columns, batch)
    return store.read_dim("dim_user", "id", columns)


@query("dim_table_steps", with_inputs("config_rows", """
  SELECT source_table, sink_table, op, ts_ms, CAST(step AS INTEGER) AS step,
         CASE WHEN op = 'd' OR op = 'u' AND step = 0 THEN 'drop' ELSE 'create' END AS action
  FROM (SELECT *, unnest(generate_series(0, CASE WHEN op = 'u' THEN 1 ELSE 0 END)) AS step FROM config_rows)"""))
def dim_table_steps(spark, sf):
    rows = config.cdc_before_after(inputs.config_changes(spark, sf))
    return lifecycle.lifecycle_steps(rows).select("source_table", "sink_table", "op", "ts_ms", "step", "action")


@query("dim_table_lifecycle", with_inputs("config_rows", """
  SELECT sink_table, unnest(string_split(sink_columns, ',')) AS column_name
  FROM (SELECT sink_table, max_by(op, (ts_ms, event_id)) AS op, max_by(sink_columns, (ts_ms, event_id)) AS sink_columns
        FROM config_rows GROUP BY sink_table)
  WHERE op <> 'd'"""))
def dim_table_lifecycle(spark, sf):
    """The config changes as DDL in a database of their own; the tables that the catalog has then."""
    rows = config.cdc_before_after(inputs.config_changes(spark, sf))
    database = f"lifecycle_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    lifecycle.apply_lifecycle(spark, rows, ("ts_ms", "event_id"), database)
    found = [(t.name, c) for t in spark.catalog.listTables(database) for c in spark.table(f"{database}.{t.name}").columns]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame(found, "sink_table string, column_name string")
