"""Streams over several micro-batches against the batch operators."""

import time

import pytest
from pyspark.sql import functions as F

from tidemart.functions import timefmt
from tidemart.operators import firsts, visitors, windows
from tidemart.session import shared_folder
from tidemart.sinks.tables import KeyedTable, MetricTable
from tidemart.streaming import joins, runs, stateful

DAY = 86_400_000
T0 = 1_736_121_600_000


def split(spark, rows, schema, parts, name="in"):
    """The rows as a stream with one file, so one micro-batch, per part."""
    path = shared_folder(spark, name)
    per = -(-len(rows) // parts)
    for i in range(0, len(rows), per):
        spark.createDataFrame(rows[i:i + per], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, stream):
    path = shared_folder(spark, "out")
    runs.to_files(stream, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


PAGE = "id int, mid string, uid string, is_new string, last_page_id string, ts bigint"


def page_rows(n=240):
    """Five devices over several days, a third of the rows on one of them; a last row far ahead."""
    rows = []
    for i in range(n):
        mid = "hot" if i % 3 == 0 else f"m{i % 4}"
        ts = T0 + i * 3_600_000 // 2 + (i * i * 7919) % 9_000 + (4_000 if i % 5 == 0 else 0)
        rows.append((i, mid, f"u{i % 2}" if i % 7 else None, "1" if i % 4 else "0", "home" if i % 6 == 1 else None, ts))
        if i % 3 == 0:
            rows.append((1000 + i, mid, "u9", "1", "home" if i % 2 else None, ts + 9_500 + i % 1_000))
    rows.sort(key=lambda r: r[5])
    return rows + [(9999, "end", None, "1", "x", T0 + 400 * DAY)]


def nested(spark, rows):
    flat = spark.createDataFrame(rows, PAGE)
    return flat.select("id", F.struct("mid", "uid", "is_new", *[F.lit(None).cast("string").alias(c) for c in (
        "sc", "ch", "ar", "vc", "ba", "md", "os")]).alias("common"), F.struct("last_page_id").alias("page"), "ts")


@pytest.fixture(scope="module")
def pages(spark):
    rows = page_rows()
    return rows, split(spark, rows, PAGE, 4)


def test_fix_is_new(spark, pages):
    rows, stream = pages
    batch = visitors.fix_is_new(nested(spark, rows), ("id",))
    got = values(run(spark, stateful.fix_is_new(stream)), "id", "mid", "is_new")
    assert got == values(batch.select("id", "common.mid", "common.is_new"), "id", "mid", "is_new")


def test_unique_visitor(spark, pages):
    rows, stream = pages
    batch = visitors.unique_visitor_daily(nested(spark, rows), ("id",))
    assert values(run(spark, stateful.unique_visitor_daily(stream)), "id", "ts") == values(batch, "id", "ts")


def test_user_jump(spark, pages):
    rows, stream = pages
    batch = visitors.user_jump(nested(spark, rows), ("id",))
    assert values(run(spark, stateful.user_jump(stream)), "id", "ts") == values(batch, "id", "ts")


def test_first_login(spark, pages):
    rows, stream = pages
    ended = split(spark, rows[:-1] + [(9999, "end", "u", "1", "x", rows[-1][5])], PAGE, 3)
    batch = visitors.first_login(nested(spark, rows[:-1]), ("id",))
    assert values(run(spark, stateful.first_login(ended)), "ts", "mid") == values(batch, "ts", "mid_id")


def test_flags_new_and_back(spark):
    rows = [(i, "hot" if i % 3 else f"u{i % 4}", T0 + i * 11 * 3_600_000 + (9 * DAY if i > 40 else 0)) for i in range(80)]
    schema = "id int, user_id string, ts bigint"
    stream = split(spark, rows, schema, 3)
    batch = spark.createDataFrame(rows, schema)
    flagged = run(spark, stateful.daily_first(stream, ["user_id"], keep_all=True))
    assert values(flagged, "id", "is_first") == values(firsts.flag_daily_first(batch, ["user_id"], "is_first"), "id", "is_first")
    daily = run(spark, stateful.daily_first(split(spark, rows, schema, 3), ["user_id"]).select(
        "user_id", "ts", stateful.is_new_user().alias("new"), stateful.is_back().alias("back")))
    assert values(daily, "user_id", "ts", "new") == values(
        visitors.user_daily_new(batch, unit="ms"), "user_id", "ts", "new_count")
    back = visitors.login_uv_back(batch)
    assert values(daily, "user_id", "ts", "back") == values(back, "user_id", "ts", "back_count")
    assert daily.agg(F.sum("back")).first()[0] > 0


def test_precombine_keeps_the_first_of_each_batch(spark):
    rows = [(i, "hot", T0 + (97 * i) % 1000) for i in range(1000)] + [(5000, "cold", T0 + 5), (5001, "hot", T0 + DAY)]
    df = spark.createDataFrame(rows, "id int, k string, ts bigint").coalesce(1)
    kept = stateful.precombine(df, ["k"])
    assert kept.count() == 3 and values(kept, "k", "ts") == [("cold", T0 + 5), ("hot", T0), ("hot", T0 + DAY)]


def test_state_is_forgotten_after_a_day(spark):
    """A row that is a day earlier than the last one counts again once the key's state has gone."""
    schema = "id int, k string, ts bigint"
    rows = [(1, "a", T0 + 10), (2, "z", T0 + 2 * DAY), (3, "z", T0 + 2 * DAY + 1), (4, "a", T0 + 2 * DAY + 2)]
    first = stateful.daily_first(split(spark, rows, schema, 4), ["k"], ttl_ms=DAY)
    got = values(run(spark, first), "id", "previous_day")
    # The second row of 'a' finds no state: without the TTL it would know the day of the first.
    assert got == [(1, -1), (2, -1), (4, -1)]
    kept = stateful.daily_first(split(spark, rows, schema, 4), ["k"])
    assert values(run(spark, kept), "id", "previous_day") == [(1, -1), (2, -1), (4, T0 // DAY)]


def test_sessions_over_batches(spark):
    schema = "session_id string, ts bigint, play_sec int, position_sec int, user_id string"
    rows = [(f"s{i % 2}", T0 + i * 1_500 + (60_000 if i > 30 else 0), 1, i, f"u{i}") for i in range(60)]
    rows.append(("end", T0 + DAY, 0, 0, "x"))
    stream = timefmt.with_event_time(split(spark, rows, schema, 4), "ms").withWatermark("event_time", "5 seconds")
    batch = timefmt.with_event_time(spark.createDataFrame(rows[:-1], schema), "ms")
    columns = ("session_id", "ts", "play_sec", "position_sec", "user_id")
    assert values(run(spark, windows.session_stream(stream)), *columns) == values(windows.session_keyed(batch), *columns)


def test_bounded_join_emits_matches_and_late_nulls(spark):
    def side(rows, schema):
        return windows.watermarked(timefmt.with_event_time(split(spark, rows, schema, 2), "s"), "5 seconds")

    t = T0 // 1000
    detail = side([("1", "o1", t), ("2", "o1", t + 1), ("3", "o2", t + 2), ("4", "end", t + 9_999)], "id string, order_id string, ts bigint")
    info = side([("o1", "s1", t + 15), ("o2", "s2", t + 18), ("end", "s", t + 9_999)], "id string, session_id string, ts bigint")
    got = run(spark, joins.join_detail_order(detail, info).select("id", "session_id"))
    # The order of line 3 comes 16 seconds after it, one too many.
    assert values(got, "id", "session_id") == [("1", "s1"), ("2", "s1"), ("4", "s")]

    orders = side([("1", "s1", t), ("2", "none", t + 1), ("9", "end", t + 9_999), ("9", "end", t + 9_999)], "id string, session_id string, ts bigint")
    log = side([("s1", "src", t + 3), ("end", "x", t + 9_999)], "session_id string, source_id string, ts bigint")
    got = run(spark, joins.join_order_source(orders, log).select("id", "source_id")).where("id < '9'")
    assert sorted(tuple(r) for r in got.collect()) == [("1", "src"), ("2", None)]


def test_micro_batches_into_tables(spark):
    """foreachBatch: a metric in append mode, an upsert in update mode."""
    rows = [(i, f"k{i % 3}", T0 + i * 4_000) for i in range(30)]
    schema = "n int, k string, ts bigint"

    def timed():
        return timefmt.with_event_time(split(spark, rows, schema, 3), "ms").withWatermark("event_time", "3 seconds")

    folder = shared_folder(spark, "tables")
    metric = MetricTable(spark, f"{folder}/metric")
    runs.to_table(windows.windowed_metric(timed(), [], ["n"]), metric, f"{folder}/c1").awaitTermination()
    batch = windows.windowed_metric(timefmt.with_event_time(spark.createDataFrame(rows, schema), "ms"), [], ["n"])
    closed = batch.where(F.unix_timestamp("edt") * 1000 <= max(r[2] for r in rows) - 3_000)
    assert values(metric.read(), "stt", "n") == values(closed, "stt", "n")

    keyed = KeyedTable(spark, f"{folder}/keyed", ["k"], [])
    counts = timed().groupBy("k").agg(F.sum("n").alias("n"), F.max("ts").alias("ts"))
    runs.to_table(counts, keyed, f"{folder}/c2", mode="update").awaitTermination()
    assert values(keyed.read(), "k", "n") == [("k0", 135), ("k1", 145), ("k2", 155)]


def test_user_jump_sorts_the_open_entry_among_older_rows(spark):
    """An entry at 100 s waits; then come an entry of 95 s, a page of 101 s, and much later the end."""
    schema = "id int, mid string, last_page_id string, ts bigint"
    rows = [(1, "a", None, T0 + 100_000), (2, "a", None, T0 + 95_000), (3, "a", "x", T0 + 101_000), (4, "z", "x", T0 + 900_000),
            (5, "z", "x", T0 + 900_001), (6, "z", "x", T0 + 900_002)]
    folder = shared_folder(spark, "order")
    for i, batch in enumerate((rows[:1], rows[1:3], rows[3:4], rows[4:5], rows[5:])):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(1.1)  # files are taken in order of their time
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    got = run(spark, stateful.user_jump(stream, delay="60 seconds"))
    assert values(got, "id") == [(2,)]


@pytest.mark.parametrize("zone", ["Asia/Shanghai", "America/New_York"])
def test_days_are_those_of_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(i, f"m{i % 3}", None, T0 + i * 5 * 3_600_000) for i in range(60)]
        schema = "id int, mid string, last_page_id string, ts bigint"
        daily = run(spark, stateful.unique_visitor_daily(split(spark, rows, schema, 3)))
        batch = firsts.daily_first(spark.createDataFrame(rows, schema), ["mid"], ["ts"])
        assert values(daily, "id", "mid", "ts") == values(batch, "id", "mid", "ts")
        back = run(spark, stateful.daily_first(split(spark, rows, schema, 3), ["mid"]).select(
            "mid", "ts", stateful.is_new_user().alias("new"), stateful.is_back().alias("back")))
        users = visitors.user_daily_new(spark.createDataFrame(rows, schema), "mid", "ms")
        assert values(back, "mid", "ts", "new") == values(users, "mid", "ts", "new_count")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_last_partner_within_the_bound_counts(spark):
    """As in the batch joins, which keep the last source, order line and attributes."""
    def side(rows, schema, unit="s"):
        return windows.watermarked(timefmt.with_event_time(split(spark, rows, schema, 2), unit), "5 seconds")

    t = T0 // 1000
    orders = side([("1", "s1", t), ("2", "none", t + 1), ("9", "end", t + 9_999), ("8", "end", t + 9_999)], "id string, session_id string, ts bigint")
    log = side([("s1", "early", t - 3), ("s1", "late", t + 4), ("s1", "middle", t + 2), ("end", "x", t + 9_999)],
               "session_id string, source_id string, ts bigint")
    got = run(spark, joins.join_order_source(orders, log).select("id", "source_id")).where("id < '8'")
    assert sorted(tuple(r) for r in got.collect()) == [("1", "late"), ("2", None)]

    paid = side([("p1", "o1", t), ("p9", "end", t + 9_999), ("p8", "end", t + 9_999)], "id string, order_id string, ts bigint")
    lines = side([("l2", "o1", "c2", t + 1), ("l1", "o1", "c1", t + 1), ("l0", "o1", "c0", t - 9), ("l9", "end", "c", t + 9_999)],
                 "id string, order_id string, course_id string, ts bigint")
    got = run(spark, joins.join_payment_detail(paid, lines).select("id", "course_id")).where("id < 'p8'")
    assert values(got, "id", "course_id") == [("p1", "c2")]
