"""Correcting joins: the changes of single rows, in their order, and the state they leave."""

import collections
import time

import pytest
from pyspark.sql import functions as F

from tidemart.session import shared_folder
from tidemart.streaming import changelog, runs

LEFT = "id string, session_id string, ts bigint, amount decimal(18,2)"
LOG = "session_id string, source_id string, ts bigint"


def until_used_up(changes, path, rows):
    """State with an idle time asks for batches for ever, so such a stream is stopped when it has its rows."""
    stream = changes.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").start(f"{path}/rows")
    for _ in range(300):
        time.sleep(0.1)
        if sum(p.numInputRows for p in stream.recentProgress) >= rows or not stream.isActive:
            break
    stream.stop()


def run(spark, steps, join, idle=False):
    """Runs a stream once per step: (left rows, right rows) are added, its present input is used up."""
    path = shared_folder(spark, "steps")
    out = []
    for lefts, rights in steps:
        for name, rows, schema in (("left", lefts, LEFT), ("right", rights, LOG)):
            plain = schema.replace("decimal(18,2)", "int")
            spark.createDataFrame(rows, plain).select(*[F.col(c).cast(t) for c, t in (x.split() for x in schema.split(", "))]).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
        streams = [spark.readStream.schema(s).parquet(f"{path}/{n}") for n, s in (("left", LEFT), ("right", LOG))]
        changes = join(*streams)
        if idle:
            until_used_up(changes, path, len(lefts) + len(rights))
        else:
            runs.to_files(changes, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
        found = spark.read.schema(changes.schema).parquet(f"{path}/rows")
        rows = collections.defaultdict(list)
        for r in sorted(found.collect(), key=lambda r: (r.change_id, r.version)):
            rows[r.change_id].append((r.op, str(r.amount), r.source_id))
        out.append((dict(rows), changelog.folded(found)))
    return out


def source(left, right, **options):
    return changelog.order_source(left, right, options.pop("idle", None), **options)


@pytest.mark.parametrize("salts", [1, 3])
def test_corrections(spark, salts):
    steps = [
        ([("a", "s1", 1, 1), ("b", "s2", 1, 2), ("n", None, 1, 3)], [("s2", "x", 5)]),
        ([], [("s1", "y", 7), ("s2", "older", 4), (None, "z", 1)]),   # after its row; an older one changes nothing
        ([("a", "s1", 2, 9), ("c", "s1", 1, 4)], [("s1", "z", 7)]),   # a partner of the same time, a row again, one more row
        ([("a", "s1", 1, 5)], [("s9", "nobody", 1)]),                 # an older row changes nothing
    ]
    got = run(spark, steps, lambda a, b: source(a, b, salts=salts))
    assert got[0][0] == {"a": [("insert", "1.00", None)], "b": [("insert", "2.00", "x")], "n": [("insert", "3.00", None)]}
    a = [("insert", "1.00", None), ("delete", "1.00", None), ("insert", "1.00", "y")]
    assert got[1][0]["a"] == a and got[1][0]["b"] == got[0][0]["b"]
    assert got[2][0]["a"] == a + [("delete", "1.00", "y"), ("insert", "9.00", "z")]
    assert got[2][0]["c"] == [("insert", "4.00", "z")] and got[3][0] == got[2][0]
    final = sorted((r.id, str(r.amount), r.source_id) for r in got[3][1].collect())
    assert final == [("a", "9.00", "z"), ("b", "2.00", "x"), ("c", "4.00", "z"), ("n", "3.00", None)]


def test_inner_waits(spark):
    def join(left, right):
        return changelog.changelog_join(left, right, "session_id", "id", ["ts"], ["amount"], ["ts", "source_id"], ["source_id"], False)

    got = run(spark, [([("a", "s1", 1, 1), ("n", None, 1, 1)], []), ([], [("s1", "x", 1)]), ([], [("s1", "y", 2)])], join)
    assert got[0][0] == {} and got[1][0] == {"a": [("insert", "1.00", "x")]}
    assert got[2][0]["a"][1:] == [("delete", "1.00", "x"), ("insert", "1.00", "y")]


def test_idle_rows_are_forgotten(spark):
    """Remembered for a millisecond, rows of an earlier run have no partner any more, and versions go on above the old ones."""
    steps = [([("a", "s1", 1, 1)], [("s2", "x", 1)]), ([("b", "s2", 1, 2)], [("s1", "y", 1)]), ([("a", "s1", 2, 3)], [])]
    got = run(spark, steps, lambda a, b: source(a, b, idle=1), True)
    assert got[1][0] == {"a": [("insert", "1.00", None)], "b": [("insert", "2.00", None)]}
    assert got[2][0]["a"] == [("insert", "1.00", None), ("insert", "3.00", None)]
    kept = run(spark, steps, lambda a, b: source(a, b, idle=3_600_000), True)
    assert kept[2][0]["a"][-1] == ("insert", "3.00", "y") and kept[2][0]["b"] == [("insert", "2.00", "x")]


def test_hot_key_is_dealt_out(spark):
    """A third of all rows have one session: with salts they lie in several groups, none of which has most of them."""
    rows = spark.range(3000).select(F.col("id").cast("string"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("session_id"))
    largest = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(8))).groupBy("session_id", "salt").count().agg(F.max("count")).first()[0]
    assert largest < 250
