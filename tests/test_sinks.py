"""Sinks: replays, deletes, compaction, table lifecycle."""

import json

from pyspark.sql import functions as F

from tidemart.operators import dims
from tidemart.session import shared_folder
from tidemart.sinks import commits, lifecycle, tables, topics
from tidemart.streaming import jobs
from tidemart.streaming.site import Site


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def keyed(spark, *data):
    return spark.createDataFrame(data, "id string, ts bigint, v string, type string")


def test_upsert_table(spark):
    table = tables.KeyedTable(spark, shared_folder(spark, "t"), ["id"], ["ts"], "type")
    table.write(keyed(spark, ("a", 1, "a1", "insert"), ("b", 1, "b1", "insert"), ("c", 1, "c1", "insert")), 0)
    second = (("a", 3, "a3", "update"), ("a", 2, "a2", "update"), ("b", 2, "b2", "delete"))
    table.write(keyed(spark, *second), 1)
    expected = [("a", "a3"), ("c", "c1")]
    assert values(table.read(), "id", "v") == expected
    table.write(keyed(spark, *second), 1)  # replay of a batch
    assert values(table.read(), "id", "v") == expected
    table.compact()
    assert [e.level for e in table.log.manifest().entries] == [1, 0]  # the newest batch may come again
    table.write(keyed(spark, *second), 1)
    assert values(table.read(), "id", "v") == expected
    # An older row does not bring a deleted key back, also from the base; a newer one does.
    table.write(keyed(spark, ("b", 1, "old", "insert"), ("c", 0, "old", "update")), 2)
    table.compact(0)
    assert values(table.read(), "id", "v") == expected
    table.write(keyed(spark, ("b", 1, "old", "insert"), ("a", 2, "old", "delete")), 3)
    assert values(table.read(), "id", "v") == expected
    table.write(keyed(spark, ("b", 5, "b5", "insert")), 4)
    assert values(table.read(), "id", "v") == [("a", "a3"), ("b", "b5"), ("c", "c1")]
    table.write(keyed(spark).limit(0), 5)
    assert values(table.read(), "id", "v") == [("a", "a3"), ("b", "b5"), ("c", "c1")]


def test_upsert_table_ties_and_null_keys(spark):
    """Rows of one key and time: the later batch counts, within a batch the greater digest, whatever the order of rows."""
    seen = set()
    for turn in (1, -1):
        table = tables.KeyedTable(spark, shared_folder(spark, "t"), ["id"], ["ts"])
        rows = [("a", 1, f"v{i}", "x") for i in range(5)] + [(None, 1, "n", "x")]
        table.write(keyed(spark, *rows[::turn]).repartition(3), 0)
        table.write(keyed(spark, ("z", 1, "z", "x"), (None, 2, "later", "x")), 1)
        table.compact(0)
        table.write(keyed(spark, (None, 1, "older", "x")), 2)
        rows = sorted(((r.id, r.v) for r in table.read().collect()), key=str)
        assert [r for r in rows if r[0] != "a"] == [("z", "z"), (None, "later")]
        seen.add(tuple(rows))
    assert len(seen) == 1


def test_upsert_table_reads_base_and_later_batches(spark):
    """A read opens the base and the batches after it, of the buckets that it asks for; the base meets no exchange while
    what is later is small."""
    table = tables.KeyedTable(spark, shared_folder(spark, "t"), ["id"], ["ts"], buckets=4, fold_every=3)
    for batch in range(9):
        table.write(keyed(spark, *[(f"k{i}", batch, f"v{batch}", "x") for i in range(batch, 30)]), batch)
    entries = table.log.manifest().entries
    assert [e.level for e in entries][0] == 1 and len(entries) <= 4
    rows = table.read()
    named = {p for _, p in table.log.folders()}
    assert len(named) == len(entries) and {f.split("/data/")[1].split("/")[0] for f in rows.inputFiles()} == {
        n.split("/data/")[1] for n in named}
    assert values(rows, "id", "v") == sorted((f"k{i}", f"v{min(i, 8)}") for i in range(30))
    bucket = table.bucket_of("k7")
    some = table.read([bucket])
    assert ("k7", "v7") in values(some, "id", "v") and some.count() < 30
    scans = [line for line in some._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert scans and all(f"bucket#" in line.split("PartitionFilters")[1] for line in scans)
    assert len(table.log._names("manifests")) <= commits.KEPT + 4 and len(table.log._names("data")) < 12


def test_metric_table_replay(spark):
    table = tables.MetricTable(spark, shared_folder(spark, "m"))
    for batch, n in ((0, 1), (1, 2), (1, 2)):
        table.write(spark.createDataFrame([(f"w{batch}", n)], "stt string, n int"), batch)
    assert values(table.read(), "stt", "n") == [("w0", 1), ("w1", 2)]


def test_metric_table_crash_between_prepare_and_commit(spark):
    """Data that was prepared but not committed shows in no read, and goes when the table is folded."""
    def rows(batch):
        return spark.createDataFrame([(f"w{batch}", batch)], "stt string, n int")

    table = tables.MetricTable(spark, shared_folder(spark, "m"))
    table.write(rows(0), 0)
    orphan, _ = table.log.prepare(rows(1))  # the writer dies here
    before = table.read()
    table = tables.MetricTable(spark, table.path)
    table.write(rows(1), 1)  # and Spark repeats the batch
    assert values(before, "n") == [(0,)] and values(table.read(), "n") == [(0,), (1,)]
    table.log.expire()
    assert orphan not in table.log._names("data")
    # A batch that a fold holds was committed before: it is not added again.
    for batch in range(2, 19):
        table.write(rows(batch), batch)
    assert [e.level for e in table.log.manifest().entries][0] == 1
    table.write(rows(3), 3)
    assert values(table.read(), "n") == [(i,) for i in range(19)]


def test_commit_log_stays_small(spark, monkeypatch):
    """Hundreds of batches, of which every third has no rows: files are bounded, and every row is there once."""
    log = commits.CommitLog(spark, shared_folder(spark, "log"))
    total = []

    def prepared(batch):
        return (None, 0) if batch % 3 == 2 else (f"f{batch}", 1)

    held = {}

    def merge(folders):
        name = "+".join(folders[:1]) + f"-{len(held)}"
        held[name] = sum((held.get(f, [f]) for f in folders), [])
        return name, 1

    for batch in range(300):
        assert log.add(batch, prepared(batch))
        if batch % 50 == 0:
            assert log.add(batch, prepared(batch))  # again
        while log.fold(merge):
            pass
        if batch % 40 == 0:
            log.expire()
    entries = log.manifest().entries
    for e in entries:
        if e.folder:
            total += held.get(e.folder, [e.folder])
    assert total == [f"f{b}" for b in range(300) if b % 3 != 2]
    assert len(entries) < 4 * commits.FAN_IN and max(e.level for e in entries) == 2
    assert [e.first for e in entries] == [0, *[e.last + 1 for e in entries[:-1]]]
    log.expire()
    assert len(log._numbers()) == commits.KEPT


def test_dim_store_batches_and_later_merge(spark):
    def changes(*data):
        return spark.createDataFrame([("dim_t", *d) for d in data] + [("dim_other", "insert", 1, {"id": "1", "a": "no"})],
                                     "sink_table string, type string, ts bigint, data map<string,string>")

    store = tables.DimStore(spark, shared_folder(spark, "d"), ["ts"])
    store.write(changes(("insert", 1, {"id": "1", "a": "x", "b": "y"}), ("insert", 1, {"id": "2", "a": "x"})), 0)
    for _ in range(2):
        store.write(changes(("update", 2, {"id": "1", "a": "z"}), ("delete", 2, {"id": "2"})), 1)
    state = store.read_dim("dim_t", "id", ["id", "a", "b"])
    assert values(state, "id", "a", "b") == [("1", "z", "y")]
    assert store.read_dim("dim_none", "id", ["id", "a"]).count() == 0
    store.fold("dim_t", "id", ["id", "a", "b"], 0)
    base = spark.read.parquet(store.base("dim_t")[1])
    assert values(base, "id", "a", "b") == [("1", "x", "y"), ("2", "x", None)]
    assert values(store.read_dim("dim_t", "id", ["id", "a", "b"]), "id", "a", "b") == [("1", "z", "y")]
    assert "insert" not in [r.type for r in store.changes("dim_t", store.base("dim_t")[0]).collect()]
    # Batches of an earlier folder than the base's are not even listed.
    store.write(changes(("update", 9, {"id": "1", "b": "v"})), 250)
    store.fold("dim_t", "id", ["id", "a", "b"], 250)
    read = store.changes("dim_t", store.base("dim_t")[0]).inputFiles()
    assert store._parts() == [0, 2] and all("part=2" in f for f in read)
    assert values(store.read_dim("dim_t", "id", ["id", "a", "b"]), "id", "a", "b") == [("1", "z", "v")]
    store.clear("dim_t")
    assert store.read_dim("dim_t", "id", ["id", "a", "b"]).count() == 0 and store.base("dim_other") == (None, None)
    store.write(changes(("insert", 10, {"id": "5", "a": "n"})), 251)
    assert values(store.read_dim("dim_t", "id", ["id", "a", "b"]), "id", "a", "b") == [("5", "n", None)]
    empty = tables.DimStore(spark, shared_folder(spark, "none"), ["ts"])
    assert empty.read_dim("dim_t", "id", ["id", "a"]).count() == 0
    later = dims.merge_dim(state, changes(("update", 1, {"id": "1", "b": "w"})).where("sink_table = 'dim_t'"),
                           "id", ["id", "a", "b"], ["ts"])
    assert values(later, "id", "a", "b") == [("1", "z", "w")]


def test_topics(spark):
    path = shared_folder(spark, "topic")
    rows = spark.createDataFrame([("t1", {"id": "1"}), ("t2", {"id": "2"})], "sink_table string, data map<string,string>")
    topics.append(topics.routed_rows(rows), path, "sink_table")
    topics.append(topics.routed_rows(rows.where("sink_table = 't1'")), path, "sink_table")
    back = spark.read.schema("value string, sink_table string").text(path)
    assert values(back, "sink_table", "value") == [("t1", '{"id":"1"}'), ("t1", '{"id":"1"}'), ("t2", '{"id":"2"}')]

    stream = spark.readStream.text(f"{path}/sink_table=t1").select(F.upper("value").alias("value"))
    out = shared_folder(spark, "topic")
    topics.append_stream(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    assert spark.read.text(f"{out}/rows").count() == 2


def test_lifecycle_job(spark):
    def config(op, sink, columns, ts):
        row = {"source_table": sink, "sink_table": sink, "sink_columns": columns}
        return json.dumps({"before": row if op == "d" else None, "after": None if op == "d" else row, "op": op, "ts_ms": ts})

    site = Site(spark, shared_folder(spark, "site"), limits={"maxFilesPerTrigger": "1"})
    folder = f"{site.root}/topics/in/topic=table_process_dim"
    for lines in ([config("c", "dim_x", "id,a", 1), config("r", "dim_y", "id", 1)], [config("u", "dim_x", "id,a,b", 2), config("d", "dim_y", "id", 2)]):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)
    for query in jobs.dim_tables(site):
        query.awaitTermination()
    assert spark.table("dim_x").columns == ["id", "a", "b"] and not spark.catalog.tableExists("dim_y")
    spark.sql("DROP TABLE dim_x")


def test_lifecycle(spark):
    rows = spark.createDataFrame(
        [("dim_a", "c", "id,x", 1), ("dim_b", "r", "id", 1), ("dim_b", "d", "id", 2), ("dim_a", "u", "id,x,y", 3)],
        "sink_table string, op string, sink_columns string, ts_ms bigint")
    steps = lifecycle.lifecycle_steps(rows)
    assert values(steps.where("sink_table = 'dim_a'"), "ts_ms", "step", "action") == [
        (1, 0, "create"), (3, 0, "drop"), (3, 1, "create")]
    lifecycle.apply_lifecycle(spark, rows.where("ts_ms = 1"))
    assert spark.catalog.tableExists("dim_a") and spark.catalog.tableExists("dim_b")
    assert spark.table("dim_a").columns == ["id", "x"]
    assert lifecycle.apply_lifecycle(spark, rows) == ["dim_a", "dim_b"]
    assert spark.table("dim_a").columns == ["id", "x", "y"] and not spark.catalog.tableExists("dim_b")
    # Dropped and created in one batch: nothing of the old table is left.
    again = spark.createDataFrame([("dim_a", "d", "id", 4), ("dim_a", "c", "id,z", 5)], rows.schema)
    lifecycle.apply_lifecycle(spark, again)
    assert spark.table("dim_a").columns == ["id", "z"]
    spark.sql("DROP TABLE dim_a")
