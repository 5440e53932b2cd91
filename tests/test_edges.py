"""Hand-made edge records per operator."""

import decimal
import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidemart import fixed, schemas
from tidemart.functions import jsontext, measures, names, text, timefmt
from tidemart.operators import dims, filters, firsts, joins, metrics, routing, splitting, visitors, windows
from tidemart.sources import cdc, config, logs, readers

DAY = 86_400_000
T0 = 1_736_121_600_000  # 2025-01-06 00:00:00


def topic(spark, *records):
    lines = [(r if r is None or isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(lines, "value string")


def page(mid, ts, last=None, is_new="1", uid="u", page_id="home", **more):
    return {"common": {"mid": mid, "uid": uid, "is_new": is_new, **more},
            "page": {"page_id": page_id, "last_page_id": last, "during_time": 5}, "ts": ts}


def pages(spark, *records):
    return logs.read_page_log(topic(spark, *records))


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# Parsing and cleaning -------------------------------------------------------------------------------

def test_dirty_lines(spark):
    lines = topic(spark, page("a", 1), '{"common":', "", None, "[1]", "12", '{"ts":"x"}')
    good, bad = logs.split_dirty(lines)
    # A value that does not fit its type is null; only what is no JSON object is dirty.
    assert sorted(map(str, good.select("common.mid", "ts").collect())) == ["Row(mid='a', ts=1)", "Row(mid=None, ts=None)"]
    assert sorted(r.value for r in bad.collect()) == ["12", "[1]", '{"common":']
    assert readers.drop_tombstones(lines).count() == 5


def envelope(**change):
    return {"database": "edu", "table": "t", "type": "insert", "ts": 1736155411, "data": {"id": 1, "a": "x"}, **change}


def test_cdc_cleaning(spark):
    rows = cdc.read_cdc_envelope(topic(
        spark, envelope(), envelope(type="delete"), envelope(type="bootstrap-start"), envelope(database="other"),
        envelope(data={"id": 1}), envelope(data=None), "{", None, ""))
    assert rows.count() == 6
    assert values(cdc.cdc_clean_dim(rows), "type") == [("delete",), ("insert",)]
    assert values(cdc.cdc_clean_fact(rows), "type", F.col("data")["id"]) == [("insert", "1")]
    assert rows.select(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).first()[0] == "2025-01-06 09:23:31"


def test_extracts_take_only_their_rows(spark):
    data = {"id": 7, "order_id": 3, "create_time": "2025-01-06 17:23:31", "final_amount": "9.50"}
    rows = cdc.read_cdc_envelope(topic(
        spark, envelope(table="order_detail", data=data), envelope(table="order_detail", type="update", data=data),
        envelope(table="order_info", data={"id": 3, "session_id": "s"}),
        envelope(table="payment_info", data={**data, "create_time": "no date"}),
        envelope(table="user_info", data={"id": 5, "create_time": None}, database="x")))
    assert values(cdc.extract_order_detail(rows), "id", "order_id", "create_date", "final_amount") == [
        ("7", "3", "2025-01-06", "9.50")]
    assert cdc.extract_order_detail(rows, ("update",)).count() == 1
    assert values(cdc.extract_order_info(rows), "id", "session_id") == [("3", "s")]
    assert values(cdc.extract_payment(rows), "id", "create_date") == [("7", None)]
    assert values(cdc.extract_user_register(rows), "id", "create_date") == [("5", None)]


# Configuration and routing --------------------------------------------------------------------------

def config_change(op, ts, table="t", sink="s", columns="id,a"):
    row = {"source_table": table, "sink_table": sink, "sink_columns": columns, "sink_family": "f", "sink_row_key": "id"}
    return {"before": row if op in "du" else None, "after": None if op == "d" else row, "op": op, "ts_ms": ts}


@pytest.mark.parametrize("ops, left", [("c", ["s0"]), ("cu", ["s1"]), ("cud", []), ("cudr", ["s3"])])
def test_config_changes(spark, ops, left):
    changes = cdc.parse_tolerant(
        topic(spark, *[config_change(op, i, sink=f"s{i}") for i, op in enumerate(ops)]),
        schemas.config_change(schemas.DIM_CONFIG))
    latest = config.config_latest(config.cdc_before_after(changes))
    assert [r.sink_table for r in latest.collect()] == left


def test_routing_prunes_and_labels(spark):
    rows = cdc.read_cdc_envelope(topic(
        spark, envelope(data={"id": 1, "a": "x", "b": "y", "type": "old"}), envelope(table="unknown"),
        envelope(type="update")))
    dim = spark.createDataFrame([("t", "dim_t", "id,b,z", "id")],
                                "source_table string, sink_table string, sink_columns string, sink_row_key string")
    routed = routing.route_by_config(rows, dim, "dim").collect()
    assert {tuple(sorted(r.data.items())) for r in routed} == {
        (("b", "y"), ("id", "1"), ("type", "insert")), (("id", "1"), ("type", "update"))}
    fact = spark.createDataFrame([("t", "insert", "dwd_t", "id,a")],
                                 "source_table string, source_type string, sink_table string, sink_columns string")
    (row,) = routing.route_by_config(rows, fact, "fact").collect()
    assert row.data == {"id": "1", "a": "x", "ts": "1736155411"}


# Log splitting --------------------------------------------------------------------------------------

def test_split_log(spark):
    common = {"mid": "m"}
    shown = [{"item": "1", "pos_id": 1, "order": 1}, {"item": "2", "pos_id": 2, "order": 2}]
    records = [
        {"common": common, "start": {"entry": "icon"}, "err": {"code": 1}, "ts": 1},
        {"common": common, "page": {"page_id": "home"}, "err": {"code": 2}, "displays": shown, "actions": [{"a": "x"}], "ts": 2},
        {"common": common, "appVideo": {"play_sec": 3, "video_id": "v"}, "page": {"page_id": "p"}, "displays": shown, "ts": 3},
        {"common": common, "page": {"page_id": "home"}, "ts": 4},
    ]
    out = splitting.split_log(topic(spark, *records))
    got = sorted((r.topic, json.loads(r.value).get("ts"), r.value) for r in out.collect())
    topics = [(t, ts) for t, ts, _ in got]
    assert topics.count((fixed.LOG_ERR, 1)) == topics.count((fixed.LOG_ERR, 2)) == 1
    assert [t for t, ts in topics if ts == 1] == [fixed.LOG_ERR, fixed.LOG_START]
    assert [t for t, ts in topics if ts == 2] == [fixed.LOG_DISPLAY, fixed.LOG_DISPLAY, fixed.LOG_ERR, fixed.LOG_PAGE]
    assert [t for t, ts in topics if ts is None] == [fixed.LOG_ACTION]
    assert [t for t, ts in topics if ts == 3] == [fixed.LOG_VIDEO]
    assert [t for t, ts in topics if ts == 4] == [fixed.LOG_PAGE]
    texts = {(t, ts): json.loads(v) for t, ts, v in got}
    assert texts[fixed.LOG_START, 1] == {"common": common, "start": {"entry": "icon"}, "ts": 1}
    assert texts[fixed.LOG_ERR, 2]["err"] == {"code": 2} and len(texts[fixed.LOG_ERR, 2]["displays"]) == 2
    assert texts[fixed.LOG_PAGE, 2] == {"common": common, "page": {"page_id": "home"}, "ts": 2}


# Visitors -------------------------------------------------------------------------------------------

def test_fix_is_new(spark):
    rows = visitors.fix_is_new(pages(
        spark, page("a", T0 + 5), page("a", T0 + DAY - 1), page("a", T0 + DAY), page("a", T0 + DAY + 9, is_new="0"),
        page("b", T0, is_new="0"), page("b", T0 + 1), page("b", T0 + DAY),
        page("c", T0 + DAY), page("c", T0)))
    assert values(rows, "common.mid", "ts", "common.is_new") == [
        ("a", T0 + 5, "1"), ("a", T0 + DAY - 1, "1"), ("a", T0 + DAY, "0"), ("a", T0 + DAY + 9, "0"),
        ("b", T0, "0"), ("b", T0 + 1, "0"), ("b", T0 + DAY, "0"), ("c", T0, "1"), ("c", T0 + DAY, "0")]


def test_unique_visitor_around_midnight(spark):
    rows = visitors.unique_visitor_daily(pages(
        spark, page("a", T0 + 7), page("a", T0 + 3), page("a", T0 + DAY - 1000), page("a", T0 + DAY),
        page("a", T0 + 1, last="x"), page("b", T0 + DAY - 1000)))
    assert values(rows, "common.mid", "ts") == [("a", T0 + 3), ("a", T0 + DAY), ("b", T0 + DAY - 1000)]


@pytest.mark.parametrize("after, last, jumps", [
    (9_999, None, 2), (10_000, None, 2), (10_001, None, 2),     # the next entry jumps as well: nothing follows it
    (9_999, "home", 0), (10_000, "home", 1), (10_001, "home", 1)])
def test_user_jump_next_page(spark, after, last, jumps):
    # The same two pages at many places of a slice, each on a device of its own.
    starts = [T0 + i for i in (0, 1, 5_000, 9_999, 10_000, 25_000, 29_999, 30_000, 30_001, 35_000, 39_999, 40_000)]
    rows = pages(spark, *[p for i, t in enumerate(starts) for p in (
        page(f"a{i}", t), page(f"a{i}", t + after, last=last), page(f"b{i}", t, last="x"))])
    for per_slice in (1, 4):
        jumped = visitors.user_jump(rows, timeouts_per_slice=per_slice).groupBy("common.mid").count().collect()
        assert [r["count"] for r in jumped] == [jumps] * (len(starts) if jumps else 0)


def test_user_jump_sequences(spark):
    three = visitors.user_jump(pages(spark, page("a", T0), page("a", T0 + 1000), page("a", T0 + 2000)))
    assert values(three, "ts", "page.page_id") == [(T0, "home"), (T0 + 1000, "home"), (T0 + 2000, "home")]
    between = visitors.user_jump(pages(spark, page("a", T0), page("a", T0 + 1, last="x"), page("a", T0 + 2)))
    assert values(between, "ts") == [(T0 + 2,)]


def test_first_login(spark):
    rows = visitors.first_login(pages(
        spark, page("a", T0 + 50, uid="late"), page("a", T0 + 10, uid="u1", ch="c"), page("a", T0, uid=None),
        page("a", T0 + DAY, uid="u2")))
    assert values(rows, "user_id", "channel", "login_time", "date_id") == [
        ("u1", "c", "2025-01-06 00:00:00", "2025-01-06"), ("u2", None, "2025-01-07 00:00:00", "2025-01-07")]


@pytest.mark.parametrize("away, back", [(7 * DAY - 1, 0), (7 * DAY, 0), (7 * DAY + 1, 1)])
def test_login_back(spark, away, back):
    # The seven days run from the midnight of the login day before, not from its login time.
    logins = spark.createDataFrame([("u", T0 + 5_000), ("u", T0 + 6_000), ("u", T0 + away)], "user_id string, ts bigint")
    assert values(visitors.login_uv_back(logins), "ts", "uv_count", "back_count") == [
        (T0 + 5_000, 1, 0), (T0 + away, 1, back)]


def test_new_users(spark):
    facts = spark.createDataFrame([("u", 100), ("u", 200), ("u", 86_400), ("v", 86_401)], "user_id string, ts bigint")
    assert values(visitors.user_daily_new(facts), "user_id", "ts", "new_count") == [
        ("u", 100, 1), ("u", 86_400, 0), ("v", 86_401, 1)]


def test_flags_keep_all_rows(spark):
    rows = spark.createDataFrame([("o", 5, "b"), ("o", 5, "a"), ("o", 9, "c"), ("o", 86_400, "d")], "o string, ts bigint, id string")
    flagged = firsts.flag_daily_first(rows, ["o"], "f", ["ts", "id"], "s")
    assert values(flagged, "id", "f") == [("a", 1), ("b", 0), ("c", 0), ("d", 1)]


# Sessions and windows -------------------------------------------------------------------------------

def plays(spark, *rows):
    df = spark.createDataFrame(list(rows), "session_id string, ts bigint, play_sec int, position_sec int, user_id string")
    return timefmt.with_event_time(df, "ms")


def test_session_gap(spark):
    rows = plays(spark, ("s", T0, 1, 10, "u"), ("s", T0 + 2_999, 2, 20, "v"), ("s", T0 + 5_999, 4, 15, "w"),
                 ("s", T0 + 9_000, 8, 1, "x"), ("r", T0, 16, 5, "y"))
    expected = [("r", T0, 16, 5, "y"), ("s", T0, 7, 15, "u"), ("s", T0 + 9_000, 8, 1, "x")]
    columns = ("session_id", "ts", "play_sec", "position_sec", "user_id")
    assert values(windows.session_keyed(rows), *columns) == expected
    assert values(windows.session_keyed(rows, slice_ms=2_000), *columns) == expected
    assert values(windows.session_stream(rows), *columns) == expected


@pytest.mark.parametrize("slice_ms", [500, 3_000, 3_001, 60_000])
def test_sessions_do_not_depend_on_slices(spark, slice_ms):
    rows = plays(spark, *[("s", T0 + i * i * 37 % 200_000, i, i, "u") for i in range(120)])
    assert values(windows.session_keyed(rows, 3_000, slice_ms), "ts", "play_sec", "position_sec") == values(
        windows.session_stream(rows, "3 seconds"), "ts", "play_sec", "position_sec")


def test_window_texts(spark):
    rows = timefmt.with_event_time(spark.createDataFrame([(T0 - 1, 1), (T0, 1)], "ts bigint, n int"), "ms")
    assert values(windows.windowed_metric(rows, [], ["n"]), "stt", "edt", "cur_date", "n") == [
        ("2025-01-05 23:59:50", "2025-01-06 00:00:00", "2025-01-05", 1),
        ("2025-01-06 00:00:00", "2025-01-06 00:00:10", "2025-01-06", 1)]


# Joins ----------------------------------------------------------------------------------------------

def test_order_detail_fact(spark):
    detail = spark.createDataFrame([("1", "o1", 5, "old"), ("1", "o1", 6, "new"), ("2", "o1", 5, "x"), ("3", "none", 5, "x")],
                                   "id string, order_id string, ts bigint, course_id string")
    info = spark.createDataFrame([("o1", "t", "b", "s1", "p")],
                                 "id string, out_trade_no string, trade_body string, session_id string, province_id string")
    log = spark.createDataFrame([("s1", "first", 1), ("s1", "last", 2), ("s2", "other", 3)], "session_id string, source_id string, ts bigint")
    rows = joins.order_detail_fact(detail, info, log)
    assert values(rows, "id", "course_id", "source_id") == [("1", "new", "last"), ("2", "x", "last")]
    assert values(joins.order_detail_fact(detail, info, log.limit(0)), "id", "source_id") == [("1", None), ("2", None)]


def test_one_row_whatever_the_columns(spark):
    """Lines and payments of one id and time: every subset of columns shows values of the same row."""
    detail = spark.createDataFrame(
        [("1", "o", 5, f"c{i}", f"n{7 * i % 5}", f"u{3 * i % 5}", decimal.Decimal(10 * i), decimal.Decimal(5 - i), decimal.Decimal(i * i % 4))
         for i in range(5)] + [("2", "o", 5, None, "n", None, None, decimal.Decimal(1), decimal.Decimal(2)),
                               ("2", "o", 5, None, None, "u", None, decimal.Decimal(1), decimal.Decimal(2))],
        "id string, order_id string, ts bigint, course_id string, course_name string, user_id string, "
        "origin_amount decimal(18,2), coupon_reduce decimal(18,2), final_amount decimal(18,2)")
    info = spark.createDataFrame([("o", "t", "b", "s", "p")],
                                 "id string, out_trade_no string, trade_body string, session_id string, province_id string")
    log = spark.createDataFrame([("s", "src", 1)], "session_id string, source_id string, ts bigint")
    full = {r.id: r.asDict() for r in joins.order_detail_fact(detail, info, log).collect()}
    names = [c for c in next(iter(full.values())) if c != "id"]
    subsets = [[n] for n in names] + [names[i::3] for i in range(3)] + [names[:4], names[4:]]
    for some in subsets:
        rows = joins.order_detail_fact(detail, info, log, ["id", *some]).collect()
        assert {r.id: r.asDict() for r in rows} == {i: {c: f[c] for c in ("id", *some)} for i, f in full.items()}, some

    paid = spark.createDataFrame([("p", "o", 5, f"a{i}", f"t{4 * i % 5}") for i in range(5)],
                                 "id string, order_id string, ts bigint, alipay_trade_no string, trade_body string")
    fact = joins.order_detail_fact(detail, info, log)
    whole = joins.payment_fact(paid, fact).collect()[0].asDict()
    for some in (["user_id"], ["alipay_trade_no"], ["trade_body", "final_amount"], ["ts", "course_id", "user_id"]):
        row = joins.payment_fact(paid, fact, ["id", *some]).collect()
        assert [r.asDict() for r in row] == [{c: whole[c] for c in ("id", *some)}], some


def test_register_without_log(spark):
    users = spark.createDataFrame([("1", "t", "d", 5), ("2", "t", "d", 6)], "id string, create_time string, create_date string, ts bigint")
    log = logs.extract_dim_log(pages(spark, page("m1", 1, uid="1", ch="a"), page("m2", 2, uid="1", ch="b"), page("m", 3, uid=None)))
    rows = joins.join_register_dim(users, log)
    assert values(rows, "user_id", "mid_id", "channel") == [("1", "m2", "b"), ("2", None, None)]
    assert rows.where("row_op_ts is null").count() == 0


def test_missing_dimension_keeps_the_fact(spark):
    facts = spark.createDataFrame([("1", 5), ("9", 6), (None, 7)], "course_id string, n int")
    course = spark.createDataFrame([("1", "c", "s")], "id string, course_name string, subject_id string")
    subject = spark.createDataFrame([("s", "sn", "g")], "id string, subject_name string, category_id string")
    category = spark.createDataFrame([("other", "x")], "id string, category_name string")
    rows = dims.dim_snowflake_3(facts, course, subject, category)
    assert sorted((r.n, r.course_name, r.subject_name, r.category_name) for r in rows.collect()) == [
        (5, "c", "sn", None), (6, None, None, None), (7, None, None, None)]


# Dimension upserts ----------------------------------------------------------------------------------

def dim_changes(spark, *rows):
    return spark.createDataFrame([(t, ts, data) for t, ts, data in rows], "type string, ts bigint, data map<string,string>")


def test_dim_upsert(spark):
    changes = dim_changes(
        spark, ("insert", 1, {"id": "1", "a": "x", "b": "y"}), ("update", 2, {"id": "1", "a": "z", "b": None}),
        ("insert", 1, {"id": "2", "a": "x"}), ("delete", 2, {"id": "2"}),
        ("insert", 1, {"id": "3", "a": "old", "b": "old"}), ("delete", 2, {"id": "3"}), ("insert", 3, {"id": "3", "a": "new"}))
    state = dims.dim_upsert(changes, "id", ["id", "a", "b"], ["ts"])
    assert values(state, "id", "a", "b") == [("1", "z", "y"), ("3", "new", None)]
    later = dim_changes(spark, ("update", 9, {"id": "1", "b": "w"}), ("delete", 9, {"id": "3"}), ("insert", 9, {"id": "4", "a": "n"}))
    merged = dims.merge_dim(state, later, "id", ["id", "a", "b"], ["ts"])
    assert values(merged, "id", "a", "b") == [("1", "z", "w"), ("4", "n", None)]


# Measures and metrics -------------------------------------------------------------------------------

def test_score_buckets(spark):
    scores = [(59.9, "[0,60)"), (60.0, "[60,70)"), (69.99, "[60,70)"), (70.0, "[70,80)"), (80.0, "[80,90)"),
              (90.0, "[90,100]"), (100.0, "[90,100]"), (100.1, ""), (0.0, "[0,60)")]
    df = spark.createDataFrame(scores, "score double, want string")
    assert df.where(measures.score_bucket(F.col("score")) != F.col("want")).count() == 0


def orders(spark, *rows):
    return spark.createDataFrame([(*r[:6], r[6]) for r in rows],
                                 "id string, order_id string, user_id string, province_id string, source_id string, final_amount string, ts bigint")


def test_order_groups(spark):
    t = T0 // 1000
    rows = orders(
        spark, ("1", "o1", "u", "p", "s", "10.25", t + 1), ("2", "o1", "u", "p", "s", "0.50", t + 2),  # two lines, one order
        ("3", "o2", "u", "p", "s", "1.00", t + 3),                                                       # same user and province
        ("4", "o3", "u", "q", "s", "2.00", t + 3), ("5", "o4", "v", "p", None, "4.00", t + 4),
        ("6", "o5", None, "p", "s", "8.00", t + 4), ("7", "o6", "v", None, "s", "16.00", t + 4),
        ("8", "o1", "u", "p", "s", "32.00", t + 86_400))
    province = spark.createDataFrame([("p", "P")], "id string, name string")
    got = metrics.province_orders(rows, province).collect()
    flat = sorted((r.stt, r.province_id, r.province_name, str(r.order_total_amount), r.order_uu_count, r.order_count) for r in got)
    assert flat == [("2025-01-06 00:00:00", "p", "P", "15.75", 2, 3), ("2025-01-06 00:00:00", "q", None, "2.00", 1, 1),
                    ("2025-01-07 00:00:00", "p", "P", "32.00", 1, 1)]
    source = spark.createDataFrame([("s", "S")], "id string, source_site string")
    got = metrics.source_orders(rows, source).collect()
    assert sorted((r.stt, r.source_name, str(r.order_total_amount), r.order_uu_count, r.order_count) for r in got) == [
        ("2025-01-06 00:00:00", "S", "29.75", 2, 4), ("2025-01-07 00:00:00", "S", "32.00", 1, 1)]


def test_exam_score_fraction_is_cut(spark):
    exams = spark.createDataFrame([("p", 59.99, 5, 10), ("p", 60.99, 5, 11)], "paper_id string, score double, duration_sec bigint, ts bigint")
    paper = spark.createDataFrame([("p", "t", "c")], "id string, paper_title string, course_id string")
    course = spark.createDataFrame([("c", "n")], "id string, course_name string")
    (row,) = metrics.exam_paper(exams.where("ts < 11"), paper, course).collect()
    assert (row.exam_total_score, row.course_name) == (59, "n")


def test_rows_without_their_value_drop_out(spark):
    exams = spark.createDataFrame([("p", None, 5, 10), ("p", 70.0, 5, 11)], "paper_id string, score double, duration_sec bigint, ts bigint")
    assert metrics.paper_rows(exams).count() == metrics.score_rows(exams).count() == 1
    reviews = spark.createDataFrame([("c", None, 1), ("c", 5, 1)], "course_id string, review_stars bigint, ts bigint")
    assert values(metrics.review_rows(reviews), "review_total_stars", "good_review_user_count") == [(5, 1)]


def test_chinese_text_and_custom_tokenizer(spark):
    df = spark.createDataFrame([(1, "Spark,  数据库 spark!"), (2, "..."), (3, None)], "id int, t string")
    assert values(text.tokenize_explode(df, "t"), "id", "keyword") == [(1, "spark"), (1, "spark"), (1, "数据库")]

    @F.pandas_udf("array<string>")
    def pairs(s):
        return s.map(lambda v: [v[i:i + 2] for i in range(0, len(v), 2)] if v else [])

    assert text.tokenize_explode(df.where("id = 2"), "t", "w", pairs).count() == 2


# Functions ------------------------------------------------------------------------------------------

def test_names():
    assert names.to_snake("orderTotalAmount") == "order_total_amount" and names.to_camel("order_total_amount") == "orderTotalAmount"
    assert names.to_snake("stt") == "stt"


def test_times(spark):
    df = spark.createDataFrame([("2025-01-06 17:23:31",)], "t string")
    millis = timefmt.datetime_to_millis("t")
    row = df.select(millis, timefmt.date_to_millis(F.lit("2025-01-06")), timefmt.millis_to_datetime(millis),
                    timefmt.millis_to_date(millis), timefmt.millis_to_compact_date(millis)).first()
    assert tuple(row) == (1736184211000, T0, "2025-01-06 17:23:31", "2025-01-06", "20250106")
    assert datetime.datetime.fromtimestamp(T0 / 1000, datetime.UTC).isoformat() == "2025-01-06T00:00:00+00:00"


def test_json_round_trip(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(jsontext.record(["a", "b"])).first()[0] == '{"a":1}'
    assert filters.filter_required_keys(df, "b").count() == 0


# Records that do not fit their schema ---------------------------------------------------------------

def test_values_of_another_type_take_nothing_with_them(spark):
    lines = topic(spark, '{"common":{"mid":"a","uid":7},"page":{"during_time":"12"},"ts":"17"}',
                  '{"common":"text","page":{"page_id":"p","during_time":[1]},"ts":5}', '{"common":{"mid":"b"},"ts":{"x":1}}')
    rows = logs.read_page_log(lines).select("common.mid", "common.uid", "page.page_id", "page.during_time", "ts").collect()
    assert sorted(map(tuple, rows), key=str) == [("a", "7", None, 12, 17), ("b", None, None, None, None), (None, None, "p", None, 5)]
    assert logs.split_dirty(lines)[1].count() == 0
    change = cdc.read_cdc_envelope(topic(spark, envelope(ts="1736155411"), envelope(xid="no number"))).collect()
    assert [r.ts for r in change] == [1736155411, 1736155411] and all(r.event_time for r in change)


def test_split_log_keeps_unknown_fields(spark):
    record = {"common": {"mid": "m", "is_new": "1", "net": "5g"}, "page": {"page_id": "p", "refer": "x"}, "trace": [1, {"a": 2}],
              "displays": [{"item": "1", "cost": 1.5}], "actions": [{"a": "b"}], "err": {"code": 1}, "ts": 9}
    lines = topic(spark, record, {"page": {"page_id": "q"}}, {"common": None, "start": None, "ts": 3}).withColumn(
        "is_new", F.when(F.col("value").contains("5g"), "0"))
    got = [(r.topic, json.loads(r.value)) for r in splitting.split_log(lines).collect() if "5g" in r.value]
    common = {"mid": "m", "is_new": "0", "net": "5g"}
    shown, ts = record["page"], 9
    assert dict(got) == {
        fixed.LOG_ERR: {**record, "common": common}, fixed.LOG_PAGE: {"common": common, "page": shown, "trace": record["trace"], "ts": ts},
        fixed.LOG_DISPLAY: {"display": {"item": "1", "cost": 1.5}, "common": common, "page": shown, "ts": ts},
        fixed.LOG_ACTION: {"action": {"a": "b"}, "common": common, "page": shown}}
    rest = [json.loads(r.value) for r in splitting.split_log(lines).collect() if "5g" not in r.value]
    assert {"page": {"page_id": "q"}} in rest and len(rest) == 2
    dirty = splitting.split_log(topic(spark, "[1]", '{"a":', page("a", 1)), dirty=True).collect()
    assert sorted(r.topic for r in dirty) == [fixed.LOG_DIRTY, fixed.LOG_DIRTY, fixed.LOG_PAGE]


def test_one_answer_on_odd_lines(spark):
    """Repeated keys, strings that look like numbers or arrays, unknown members: good for both or dirty for both, and kept."""
    good = [
        '{"common":{"mid":"m","uid":"1","uid":"1"},"page":{"page_id":"p"},"ts":1}',
        '{"common":{"mid":"m"},"page":{"page_id":"p"},"x":"5","y":5,"z":null,"q":"a\\"b\\\\","w":"[1","displays":[{"item":"1"},{"item":"[2"}],"ts":2}',
        '{"common":{"mid":"m"},"start":{"entry":"e"},"err":{"code":"5"},"x":"5","x":"true","ts":3}',
        '{"common":{"mid":"m"},"page":{"page_id":"p"},"actions":[{"a":1,"a":2}],"displays":["s",7],"ts":"4"}',
        '{"common":"none","page":"{}","ts":5}',
        ' {"appVideo" : {"play_sec" : 3} , "ts" : 6 }',
        '{"common":{},"err":{},"\\u00e9\\"":1,"ts":7}']
    bad = ["[1]", '{"a":', "7", '"x"', "null", "nothing"]
    lines = topic(spark, *good, *bad)
    assert sorted(r.value for r in logs.split_dirty(lines)[1].collect()) == sorted(bad)
    rows = splitting.split_log(lines, dirty=True).collect()
    assert sorted(r.value for r in rows if r.topic == fixed.LOG_DIRTY) == sorted(bad)
    pairs = lambda text: json.loads(text, object_pairs_hook=list)
    def rest(text, *names):
        return [(k, v) for k, v in pairs(text) if k not in names]
    out = {}
    for r in rows:
        if r.topic != fixed.LOG_DIRTY:
            out.setdefault(r.topic, []).append(pairs(r.value))
    assert sorted(out[fixed.LOG_PAGE], key=str) == sorted(
        [rest(g, "displays", "actions", "err") for i, g in enumerate(good) if i in (0, 1, 3, 4, 6)], key=str)
    assert sorted(out[fixed.LOG_ERR], key=str) == sorted([pairs(good[2]), pairs(good[6])], key=str)
    assert out[fixed.LOG_START] == [rest(good[2], "err")] and out[fixed.LOG_VIDEO] == [pairs(good[5])]
    assert sorted((dict(d)["display"] for d in out[fixed.LOG_DISPLAY]), key=str) == sorted(
        [[("item", "1")], [("item", "[2")], "s", 7], key=str)
    assert [dict(a)["action"] for a in out[fixed.LOG_ACTION]] == [[("a", 1), ("a", 2)]]
    # A corrected is_new replaces every field of that name, or comes first; nothing else changes.
    new = splitting.page_only(topic(spark, good[0], '{"common":{"is_new":"1","mid":"m","is_new":"1"},"ts":8}', good[4]).withColumn("is_new", F.lit("0")))
    assert sorted(r.value for r in new.collect()) == sorted([
        '{"common":{"is_new":"0","mid":"m","uid":"1","uid":"1"},"page":{"page_id":"p"},"ts":1}',
        '{"common":{"is_new":"0","mid":"m","is_new":"0"},"ts":8}', good[4]])
