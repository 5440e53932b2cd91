"""All jobs, layer by layer, on topics in folders; each layer against the batch operators."""

import json

import pytest
from pyspark.sql import functions as F

from tidemart import fixed, schemas
from tidemart.functions import timefmt
from tidemart.operators import joins, metrics, visitors, windows
from tidemart.session import shared_folder
from tidemart.sources import cdc, logs
from tidemart.streaming import jobs
from tidemart.streaming.site import Site

T0 = 1_736_121_600_000
DAY = 86_400_000
END = T0 + 30 * DAY


def log_lines():
    out = []
    for i in range(40):
        user, at = i % 6, T0 + i * 700_000 + (i // 20) * 8 * DAY
        common = {"mid": f"m{user}", "uid": str(user) if i % 5 else None, "is_new": "1", "sid": f"s{i}", "sc": str(user % 2),
                  "ar": str(user % 3), "vc": "v1", "ch": "c", "ba": "b", "md": "m", "os": "o"}
        out.append({"common": common, "page": {"page_id": "home", "during_time": 100}, "ts": at,
                    "displays": [{"item": "1", "pos_id": 1}], "err": {"code": 1} if i % 7 == 0 else None})
        if i % 4:
            out.append({"common": common, "page": {"page_id": "course_list", "last_page_id": "home", "during_time": 50,
                                                   "item": "Spark 数据库 spark", "item_type": "keyword"}, "ts": at + 3_000})
            out.append({"common": common, "page": {"page_id": "order", "last_page_id": "course_list", "during_time": 7}, "ts": at + 6_000,
                        "actions": [{"action_id": "pay"}]})
        for n in range(i % 3):
            out.append({"common": common, "appVideo": {"play_sec": 10 + n, "position_sec": n, "video_id": str(i % 4)}, "ts": at + 8_000 + n * 2_500})
        out.append({"common": common, "start": {"entry": "icon"}, "ts": at + 500})
    out.append({"common": {"mid": "end", "uid": "end", "is_new": "0", "sid": "end", "sc": "9"}, "page": {"page_id": "home", "during_time": 0, "item": "end", "item_type": "keyword"}, "ts": END})
    out.append({"common": {"mid": "end", "uid": "end", "is_new": "0", "sid": "end", "sc": "9"}, "page": {"page_id": "order", "during_time": 0}, "ts": END + 1})
    # The login of 'end' waits for its timer until a still later record comes.
    out.append({"common": {"mid": "end2", "uid": "end2", "is_new": "0", "sid": "end2", "sc": "9"}, "page": {"page_id": "home", "last_page_id": "x", "during_time": 0}, "ts": END + DAY})
    out.append({"common": {"mid": "end", "uid": "end", "is_new": "0", "sid": "end", "sc": "9"}, "appVideo": {"play_sec": 0, "video_id": "0"}, "ts": END})
    # A joined fact comes out when the watermark has passed it: each layer of joins needs a later record.
    for name, at in (("end2", END + DAY + 1), ("end3", END + 2 * DAY)):
        out.append({"common": {"mid": name, "uid": name, "is_new": "0", "sid": name, "sc": "9"},
                    "page": {"page_id": "order", "last_page_id": "x", "during_time": 0}, "ts": at})
    return [json.dumps(r, ensure_ascii=False) for r in out] + ['{"common":', ""]


def change(table, ts, data, kind="insert", xid=1):
    return json.dumps({"database": "edu", "table": table, "type": kind, "ts": ts, "xid": xid, "commit": True, "data": data})


def stamp(s):
    import datetime

    return datetime.datetime.fromtimestamp(s, datetime.UTC).strftime("%Y-%m-%d %H:%M:%S")


def db_lines():
    out = []
    for i in range(40):
        user, s = i % 6, T0 // 1000 + i * 700 + (i // 20) * 8 * 86_400 + 8
        if i % 4:
            out.append(change("order_info", s, {"id": i, "user_id": user, "out_trade_no": f"t{i}", "trade_body": "b", "session_id": f"s{i}", "province_id": user % 3}))
            for n in range(1 + i % 2):
                out.append(change("order_detail", s, {
                    "id": f"{i}-{n}", "course_id": i % 3, "course_name": "c", "order_id": i, "user_id": user, "origin_amount": "10.00",
                    "coupon_reduce": "0.00", "final_amount": f"{i}.25", "create_time": stamp(s)}))
        if i % 4 == 1:
            out.append(change("payment_info", s + 4, {"id": f"p{i}", "order_id": i, "out_trade_no": f"t{i}", "total_amount": "1.00", "create_time": stamp(s)}))
        if i < 6:
            out.append(change("user_info", s - 5, {"id": i, "create_time": stamp(s)}))
        out.append(change("cart_info", s, {"id": i, "user_id": user, "course_id": i % 3, "noise": "x"}))
        out.append(change("review_info", s, {"id": i, "user_id": user, "course_id": i % 3, "review_stars": i % 5 + 1}))
        out.append(change("test_exam", s, {"id": i, "paper_id": i % 2, "user_id": user, "score": 55.5 + i, "duration_sec": 30}))
        out.append(change("test_exam_question", s, {"id": i, "question_id": i % 4, "paper_id": 1, "user_id": user, "is_correct": str(i % 2)}))
    e = END // 1000
    out += [change("order_info", e, {"id": "end", "user_id": "end", "session_id": "end", "province_id": "0"}),
            change("order_detail", e, {"id": "end", "order_id": "end", "user_id": "end", "course_id": "0", "final_amount": "0"}),
            change("payment_info", e, {"id": "end", "order_id": "end"}), change("user_info", e, {"id": "end", "create_time": stamp(e)}),
            change("cart_info", e, {"id": "end", "user_id": "end"}), change("review_info", e, {"id": "end", "review_stars": 1}),
            change("test_exam", e, {"id": "end", "paper_id": "end", "score": 0, "duration_sec": 0}),
            change("test_exam_question", e, {"id": "end", "question_id": "end"})]
    for name, later in (("end2", e + DAY // 1000), ("end3", e + 2 * DAY // 1000)):
        out += [change("order_info", later, {"id": name, "user_id": "end", "session_id": name, "province_id": "0"}),
                change("order_detail", later, {"id": name, "order_id": name, "user_id": "end", "course_id": "0", "final_amount": "abc"}),
                change("payment_info", later, {"id": name, "order_id": name}), change("user_info", later, {"id": name, "create_time": stamp(later)})]
    t = T0 // 1000
    for i in range(3):
        out.append(change("base_province", t, {"id": i, "name": f"old{i}"}))
        out.append(change("base_province", t, {"id": i, "name": f"P{i}"}, "update", 2))
        out.append(change("base_source", t, {"id": i, "source_site": f"S{i}"}))
        out.append(change("course_info", t, {"id": i, "course_name": f"C{i}", "subject_id": i, "price": "1"}))
        out.append(change("base_subject_info", t, {"id": i, "subject_name": f"J{i}", "category_id": 0}))
        out.append(change("test_paper", t, {"id": i, "paper_title": f"T{i}", "course_id": i}))
    for i in range(4):
        out.append(change("video_info", t, {"id": i, "chapter_id": i % 2}))
        out.append(change("chapter_info", t, {"id": i, "chapter_name": f"H{i}"}))
        out.append(change("test_question_info", t, {"id": i, "question_txt": f"Q{i}"}))
    out.append(change("base_category_info", t, {"id": 0, "category_name": "G"}))
    out.append(change("base_source", t + 1, {"id": 1, "source_site": "S1"}, "delete"))
    return out + ["{"]


DIMS = {"base_province": "id,name", "base_source": "id,source_site", "course_info": "id,course_name,subject_id",
        "base_subject_info": "id,subject_name,category_id", "base_category_info": "id,category_name",
        "video_info": "id,chapter_id", "chapter_info": "id,chapter_name", "test_paper": "id,paper_title,course_id",
        "test_question_info": "id,question_txt"}
FACTS = {"cart_info": (fixed.FACT_CART_ADD, "id,user_id,course_id"), "review_info": (fixed.FACT_REVIEW, "id,user_id,course_id,review_stars"),
         "test_exam": (fixed.FACT_EXAM_PAPER, "id,paper_id,user_id,score,duration_sec"),
         "test_exam_question": (fixed.FACT_EXAM_QUESTION, "id,question_id,paper_id,user_id,is_correct")}


@pytest.fixture(scope="module")
def site(spark):
    site = Site(spark, shared_folder(spark, "site"))
    for name, lines in ((fixed.TOPIC_LOG, log_lines()), (fixed.TOPIC_DB, db_lines())):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{site.root}/topics/in/topic={name}")
    dim_rows = [(t, f"dim_{t}", c, "id", "r", 1) for t, c in DIMS.items()] + [("order_info", "dim_gone", "id", "id", "d", 2)]
    spark.createDataFrame(dim_rows, "source_table string, sink_table string, sink_columns string, sink_row_key string, op string, ts_ms bigint"
                          ).write.parquet(f"{site.root}/config/table_process_dim")
    fact_rows = [(t, "insert", topic, c, "r", 1) for t, (topic, c) in FACTS.items()]
    spark.createDataFrame(fact_rows, "source_table string, source_type string, sink_table string, sink_columns string, op string, ts_ms bigint"
                          ).write.parquet(f"{site.root}/config/table_process_dwd")
    for layer in jobs.LAYERS:
        for start in layer.values():
            for query in start(site):
                query.awaitTermination()
    return site


def batch_lines(site, topic):
    return site.spark.read.text(f"{site.root}/topics/*/topic={topic}")


def batch_facts(site, topic, schema):
    typed = [c.split() for c in schema.split(", ")]
    rows = cdc.parse_tolerant(batch_lines(site, topic), ", ".join(f"{n} string" for n, _ in typed))
    return rows.select(*[F.col(n).cast(t).alias(n) for n, t in typed])


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(str(v) for v in r) for r in df.select(*names).collect()))


def same(site, name, expected):
    got = site.metric_table(name).read()
    assert sorted(got.columns) == sorted(expected.columns)
    early = F.col("stt") < "2025-02-01"
    assert rows_of(got.where(early)) == rows_of(expected.where(early))
    assert got.count() > 0


def test_log_topics(site):
    counts = {t: batch_lines(site, t).count() for t in (
        fixed.LOG_DIRTY, fixed.LOG_START, fixed.LOG_ERR, fixed.LOG_PAGE, fixed.LOG_ACTION, fixed.LOG_DISPLAY, fixed.LOG_VIDEO)}
    assert counts == {fixed.LOG_DIRTY: 1, fixed.LOG_START: 40, fixed.LOG_ERR: 6, fixed.LOG_PAGE: 105, fixed.LOG_ACTION: 30,
                      fixed.LOG_DISPLAY: 40, fixed.LOG_VIDEO: 40}
    flags = logs.read_page_log(batch_lines(site, fixed.LOG_PAGE)).where("common.mid not like 'end%'")
    assert flags.where(f"common.is_new = '1' and ts >= {T0 + DAY}").count() == 0
    assert flags.where(f"common.is_new = '0' and ts < {T0 + DAY}").count() == 0


def test_dimensions(site):
    assert rows_of(site.dim("dim_base_province", "name")) == [(str(i), f"P{i}") for i in range(3)]
    assert rows_of(site.dim("dim_base_source", "source_site")) == [("0", "S0"), ("2", "S2")]
    assert site.dim_store().changes("dim_gone").count() == 0


def test_order_facts(site):
    facts = batch_facts(site, fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL).where("id not like 'end%'")
    assert facts.count() == facts.select("id").distinct().count() == sum(1 + i % 2 for i in range(40) if i % 4)
    assert facts.where("source_id is null or source_id != cast(user_id as int) % 2").count() == 0
    paid = batch_facts(site, fixed.FACT_PAYMENT, schemas.PAYMENT_DETAIL).where("id not like 'end%'")
    assert paid.count() == 10 and paid.where("course_id is null").count() == 0
    users = batch_facts(site, fixed.FACT_REGISTER, "user_id string, register_date string, mid_id string").where("user_id not like 'end%'")
    # Users 0 and 5 have no page with their id near the registration.
    assert rows_of(users.select("user_id", "mid_id")) == sorted(
        ("None" if i in (0, 5) else f"m{i}", str(i)) for i in range(6))


def test_fact_tables(site):
    """The tables of the correcting joins hold what the batch joins over all rows give; the topics leave out partners
    that are further away than the bound."""
    changes = cdc.read_cdc_envelope(batch_lines(site, fixed.TOPIC_DB), None)
    pages = logs.read_page_log(batch_lines(site, fixed.LOG_PAGE))
    batch = joins.order_detail_fact(cdc.extract_order_detail(changes), cdc.extract_order_info(changes), logs.extract_order_log(pages))
    table = site.fact_table(fixed.FACT_ORDER_DETAIL).read()
    assert rows_of(table.select(*batch.columns)) == rows_of(batch) and batch.where("source_id is not null").count() > 40
    lines = batch_facts(site, fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL)
    paid = joins.payment_fact(cdc.extract_payment(changes), lines.select("id", "order_id", *joins.PAID_COLUMNS, "ts"))
    assert rows_of(site.fact_table(fixed.FACT_PAYMENT).read().select(*paid.columns)) == rows_of(paid)
    users = joins.join_register_dim(cdc.extract_user_register(changes), logs.extract_dim_log(pages), now=False)
    got = site.fact_table(fixed.FACT_REGISTER).read()
    assert rows_of(got.select(*users.columns)) == rows_of(users)
    # Users 0 and 5 have pages, but none near their registration: the bounded join of the topic leaves them out.
    assert got.where("user_id in ('0', '5') and mid_id is not null").count() == 2


def test_study_plays(site):
    plays = timefmt.with_event_time(logs.flatten_play(cdc.parse_tolerant(batch_lines(site, fixed.LOG_VIDEO), schemas.LOG)), "ms")
    batch = windows.session_keyed(plays).where(f"ts < {END}")
    got = batch_facts(site, fixed.FACT_STUDY_PLAY, "session_id string, play_sec bigint, position_sec int, ts bigint").where(f"ts < {END}")
    assert rows_of(got) == rows_of(batch.select("session_id", "play_sec", "position_sec", "ts"))
    assert got.agg(F.max("play_sec")).first()[0] == 21


def test_traffic_metrics(site):
    def pages(topic):
        return logs.read_page_log(batch_lines(site, topic))

    page = pages(fixed.LOG_PAGE)
    source, province = site.dim("dim_base_source", "source_site"), site.dim("dim_base_province", "name")
    same(site, fixed.METRIC_TRAFFIC, metrics.traffic(page, source, province))
    same(site, fixed.METRIC_KEYWORD, metrics.keyword(page))
    same(site, fixed.METRIC_PAGE_VIEW, metrics.page_view(page))
    same(site, fixed.METRIC_LOGIN, metrics.user_login(visitors.first_login(page)))
    back = site.metric_table(fixed.METRIC_LOGIN).read().agg(F.sum("back_count")).first()[0]
    assert back > 0
    plays = logs.flatten_play(cdc.parse_tolerant(batch_lines(site, fixed.LOG_VIDEO), schemas.LOG))
    same(site, fixed.METRIC_CHAPTER_PLAY, metrics.chapter_play(
        plays, site.dim("dim_video_info", "chapter_id"), site.dim("dim_chapter_info", "chapter_name")))


def test_trade_metrics(site):
    orders = batch_facts(site, fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL)
    paid = batch_facts(site, fixed.FACT_PAYMENT, schemas.PAYMENT_DETAIL)
    same(site, fixed.METRIC_CART_ADD, metrics.cart_add(batch_facts(site, fixed.FACT_CART_ADD, schemas.CART_ADD)))
    same(site, fixed.METRIC_ORDER_USERS, metrics.order_users(orders))
    same(site, fixed.METRIC_PAY_USERS, metrics.pay_users(paid))
    same(site, fixed.METRIC_COURSE_ORDERS, metrics.course_orders(
        orders, site.dim("dim_course_info", "course_name", "subject_id"), site.dim("dim_base_subject_info", "subject_name", "category_id"),
        site.dim("dim_base_category_info", "category_name")))
    same(site, fixed.METRIC_SOURCE_ORDERS, metrics.source_orders(orders, site.dim("dim_base_source", "source_site")))
    same(site, fixed.METRIC_PROVINCE_ORDERS, metrics.province_orders(orders, site.dim("dim_base_province", "name")))
    same(site, fixed.METRIC_REGISTER, metrics.user_register(batch_facts(site, fixed.FACT_REGISTER, schemas.REGISTER)))


def test_study_metrics(site):
    course = site.dim("dim_course_info", "course_name")
    papers = batch_facts(site, fixed.FACT_EXAM_PAPER, schemas.EXAM_PAPER)
    paper = site.dim("dim_test_paper", "paper_title", "course_id")
    same(site, fixed.METRIC_REVIEW, metrics.course_review(batch_facts(site, fixed.FACT_REVIEW, schemas.REVIEW), course))
    same(site, fixed.METRIC_EXAM_PAPER, metrics.exam_paper(papers, paper, course))
    same(site, fixed.METRIC_EXAM_SCORE, metrics.exam_score(papers, paper))
    same(site, fixed.METRIC_EXAM_QUESTION, metrics.exam_question(
        batch_facts(site, fixed.FACT_EXAM_QUESTION, schemas.EXAM_QUESTION), site.dim("dim_test_question_info", "question_txt")))
