"""One key with a third of all rows: right results, and plans that spread it."""

import collections

import pytest
from pyspark.sql import functions as F

from tidemart.functions import timefmt
from tidemart.operators import firsts, joins, metrics, visitors, windows

T0 = 1_736_121_600_000
DAY = 86_400_000
N = 30_000


@pytest.fixture(scope="module")
def pages(spark):
    i = F.col("id")
    mid = F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), (i % 500).cast("string")))
    ts = F.lit(T0) + (i * 104_729) % (3 * DAY)
    none = F.lit(None).cast("string")
    rows = spark.range(0, N, numPartitions=8).select(
        "id", F.struct(mid.alias("mid"), F.concat(F.lit("u"), mid).alias("uid"), F.when(i % 4 == 0, "0").otherwise("1").alias("is_new"),
                       *[none.alias(c) for c in ("sc", "ch", "ar", "vc", "ba", "md", "os", "sid")]).alias("common"),
        F.struct(F.when(i % 5 == 0, "home").alias("last_page_id"), F.lit("home").alias("page_id")).alias("page"), ts.alias("ts"))
    return rows.cache()


@pytest.fixture(scope="module")
def by_device(pages):
    devices = collections.defaultdict(list)
    for r in sorted(pages.select("ts", "id", "common.mid", "common.is_new", "page.last_page_id").collect()):
        devices[r.mid].append(r)
    assert len(devices["hot"]) * 3 == N
    return devices


def test_jump_by_brute_force(pages, by_device):
    expected = set()
    for rows in by_device.values():
        for r, after in zip(rows, [*rows[1:], None]):
            if r.last_page_id is None and (after is None or after.last_page_id is None or after.ts - r.ts >= 10_000):
                expected.add(r.id)
    assert {r.id for r in visitors.user_jump(pages, ("id",)).select("id").collect()} == expected


def test_new_flag_by_brute_force(pages, by_device):
    expected = {}
    for rows in by_device.values():
        day = rows[0].ts // DAY - (rows[0].is_new != "1")
        for r in rows:
            expected[r.id] = "0" if r.is_new == "1" and r.ts // DAY != day else r.is_new
    got = visitors.fix_is_new(pages, ("id",)).select("id", "common.is_new").collect()
    assert {r.id: r.is_new for r in got} == expected


def test_unique_and_sessions_by_brute_force(spark, pages, by_device):
    expected = set()
    for rows in by_device.values():
        days = {}
        for r in rows:
            if r.last_page_id is None:
                days.setdefault(r.ts // DAY, r.id)
        expected |= set(days.values())
    assert {r.id for r in visitors.unique_visitor_daily(pages, ("id",)).select("id").collect()} == expected

    plays = timefmt.with_event_time(pages.select(
        F.col("common.mid").alias("session_id"), "ts", F.lit(1).alias("play_sec"), F.col("id").alias("position_sec")), "ms")
    sessions = collections.Counter()
    for mid, rows in by_device.items():
        last = None
        for r in rows:
            if last is None or r.ts - last > 20_000:
                start = r.ts
            sessions[mid, start] += 1
            last = r.ts
    got = windows.session_keyed(plays, 20_000, 60_000)
    assert {(r.session_id, r.ts): r.play_sec for r in got.collect()} == dict(sessions)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _window_keys(df):
    """Partition columns of each window in the plan."""
    return [line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in _plan(df).splitlines()
            if "windowspecdefinition(" in line]


def test_windows_are_bounded_in_time(pages):
    # No window over the rows of a device or user as a whole: by device and slice, or over one row per day.
    (jump,) = _window_keys(visitors.user_jump(pages, ("id",)))
    assert "_slice" in jump
    for make in (visitors.unique_visitor_daily, visitors.first_login, visitors.fix_is_new):
        assert _window_keys(make(pages, ("id",))) == []
    plan = _plan(visitors.login_uv_back(pages.select(F.col("common.uid").alias("user_id"), "ts")))
    assert plan.index("Window") < plan.index("partial_min")


def test_hot_key_is_combined_before_the_shuffle(spark, pages):
    """Of a device's rows at most one per task and day goes into the shuffle."""
    entries = pages.where("common.mid = 'hot'").select("id", F.col("common.mid").alias("mid"), "ts")
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        empty = spark.sparkContext._jvm.java.util.ArrayList
        stages = store.stageList(empty(), False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), empty())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    pages.count()
    before = written()
    firsts.daily_first(entries, ["mid"], ["ts", "id"]).write.format("noop").mode("overwrite").save()
    assert written() - before <= 8 * 3


@pytest.fixture
def shuffled_joins(spark):
    """Joins by shuffle, with skew limits that small test data reaches."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _lines(spark, key):
    i = F.col("id")
    return spark.range(0, 60_000, numPartitions=8).select(
        i.cast("string").alias("id"), F.when(i % 3 == 0, "hot").otherwise((i % 5000).cast("string")).alias(key),
        F.sha2(i.cast("string"), 256).alias("payload"), i.alias("ts"))


def _is_cut(df, rows):
    got = df.collect()
    assert len(got) == rows
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    return got


def test_hot_order_is_cut(spark, shuffled_joins):
    info = spark.range(0, 5001).select(
        F.when(F.col("id") == 5000, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        *[F.lit("x").alias(c) for c in joins.ORDER_COLUMNS])
    got = _is_cut(joins.join_detail_order(_lines(spark, "order_id"), info), 60_000)
    assert all(r.trade_body == "x" for r in got)


def test_hot_session_is_cut(spark, shuffled_joins):
    i = F.col("id")
    log = spark.range(0, 20_000, numPartitions=4).select(
        F.when(i % 4 == 0, "hot").otherwise((i % 4000).cast("string")).alias("session_id"),
        i.cast("string").alias("source_id"), i.alias("ts"))
    got = _is_cut(joins.join_order_source(_lines(spark, "session_id"), log), 60_000)
    assert {r.source_id for r in got if r.session_id == "hot"} == {"19996"}


def test_hot_device_is_cut(shuffled_joins, pages):
    _is_cut(visitors.fix_is_new(pages, ("id",)), N)


def test_hot_user_in_order_metric(spark):
    i = F.col("id")
    rows = spark.range(0, 20_000, numPartitions=8).select(
        i.cast("string").alias("id"), F.when(i % 3 == 0, "hot").otherwise((i % 700).cast("string")).alias("order_id"),
        F.when(i % 3 == 0, "hotuser").otherwise((i % 90).cast("string")).alias("user_id"),
        F.when(i % 3 == 0, "0").otherwise((i % 4).cast("string")).alias("source_id"), F.lit("1.50").alias("final_amount"), (F.lit(T0 // 1000) + i * 13).alias("ts"))
    source = spark.createDataFrame([("0", "zero")], "id string, source_site string")
    lines = rows.collect()
    amount, users, orders = collections.Counter(), collections.Counter(), collections.Counter()
    seen = set()
    for r in sorted(lines, key=lambda r: (r.ts, r.id)):
        w, day = r.ts // 86_400, r.ts // 86_400
        amount[w, r.source_id] += 1
        for counter, key in ((orders, ("o", r.order_id, day)), (users, ("u", r.user_id, r.source_id, day))):
            if key not in seen:
                seen.add(key)
                counter[w, r.source_id] += 1
    got = metrics.source_orders(rows, source, "1 day").withColumn("w", (F.unix_timestamp("stt") / 86_400).cast("int")).collect()
    assert {(r.w, r.source_id): (float(r.order_total_amount), r.order_uu_count, r.order_count) for r in got} == {
        k: (amount[k] * 1.5, users[k], orders[k]) for k in amount}


def test_batches_start_from_more_parts_than_streams(spark, monkeypatch):
    """A task's share of a large shuffle must not be a core's share of it; streams keep a state store per core."""
    from tidemart.plans import registry

    key, parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.shuffle.partitions"
    monkeypatch.setattr(registry, "QUERIES", {})
    before = {k: spark.conf.get(k, None) for k in (key, parts)}
    spark.conf.unset(key)
    try:
        registry.query("grouped")(lambda spark, sf: spark.range(1000).selectExpr("id % 500 AS k").groupBy("k").count())
        df = registry.QUERIES["grouped"](spark, "")
        assert "hashpartitioning(k#" in (plan := df._jdf.queryExecution().executedPlan().toString()) and f", {registry.BATCH_PARTS})" in plan
        assert spark.conf.get(parts) == before[parts] and df.count() == 500
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
