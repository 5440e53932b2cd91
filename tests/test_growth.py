"""Work per row that must not grow: what is parsed, compiled, shuffled and written."""

import json

from tidemart.operators import splitting
from tidemart.session import shared_folder
from tidemart.sinks import tables
from tidemart.sources import cdc


def _change(table, **data):
    return json.dumps({"database": "edu", "table": table, "type": "insert", "ts": 1, "data": data})


def test_only_lines_that_may_be_of_a_table_are_parsed(spark):
    other = _change("user_info", id="4", note="of order_detail")
    lines = [_change("order_detail", id="1"), _change("order_detail", id="2").replace("order_detail", "order\\u005fdetail"),
             _change("order_info", id="3"), other, "{order_detail", "", None]
    topic = spark.createDataFrame([(v,) for v in lines], "value string")
    rows = cdc.read_cdc_envelope(topic, tables=["order_detail"])
    assert sorted(r.id for r in rows.select(*cdc.fields("id")).collect()) == ["1", "2"]
    assert sorted(r.id for r in cdc.read_cdc_envelope(topic).select(*cdc.fields("id")).collect()) == ["1", "2", "3", "4"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.index("Contains(value")


def test_generators_of_the_splitter_only_hand_on(spark):
    """A generator that holds a function without compiled form is interpreted as a whole."""
    rows = splitting.split_log(spark.createDataFrame([('{"common":{"mid":"m"},"ts":1}',)], "value string"))
    steps = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in line]
    assert len(steps) > 3
    assert all("explode(array(_step#" in s or "inline(_out#" in s for s in steps)


def test_keyed_table_shuffles_a_batch_once_and_no_digest_on_reading(spark, monkeypatch):
    table = tables.KeyedTable(spark, shared_folder(spark, "t"), ["id"], ["ts"], buckets=4)
    plans, prepare = [], table.log.prepare

    def seen(rows, partition=None):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return prepare(rows, partition)

    monkeypatch.setattr(table.log, "prepare", seen)
    batches = [[("a", 1, "x"), ("b", 5, "x"), ("a", 2, "y"), (None, 1, "n")], [("a", 2, "z"), ("b", 4, "z"), ("c", 1, None), (None, None, "m")]]
    for number, rows in enumerate(batches):
        table.write(spark.createDataFrame(rows, "id string, ts bigint, v string"), number)
    assert len(plans) == 2 and not any("Repartition" in p for p in plans)
    got = table.read()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 2, "z"), ("b", 5, "x"), ("c", 1, None), (None, 1, "n")], key=str)
    assert "md5" not in got._jdf.queryExecution().optimizedPlan().toString()
    only = tables.KeyedTable(spark, table.path, ["id"], ["ts"], buckets=4).read([table.bucket_of("a")]).where("id = 'a'")
    assert [r.v for r in only.collect()] == ["z"]


def test_keyed_table_writes_a_file_per_bucket_where_nothing_merges_parts(spark):
    """As in a micro-batch."""
    table = tables.KeyedTable(spark, shared_folder(spark, "t"), ["id"], ["ts"], buckets=4)
    rows = spark.range(400, numPartitions=4).selectExpr("cast(id as string) AS id", "id AS ts")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table.write(rows, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [e.files for e, _ in table.log.folders()] == [4] and table.read().count() == 400


def test_batch_queries_read_files_in_small_splits(spark, monkeypatch):
    """A map task sorts its share of wide rows before the partial aggregate; a chosen size stays."""
    from tidemart.plans import registry

    key = "spark.sql.files.maxPartitionBytes"
    monkeypatch.setattr(registry, "QUERIES", {})
    registry.query("read")(lambda spark, sf: spark.range(1))
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        registry.QUERIES["read"](spark, "")
        assert spark.conf.get(key) == registry.SPLIT
        spark.conf.set(key, "7m")
        registry.QUERIES["read"](spark, "")
        assert spark.conf.get(key) == "7m"
    finally:
        spark.conf.set(key, before)
