"""The jobs of the warehouse, as streams between topics and tables.

Each function starts one job on a Site and returns its streaming queries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed, schemas
from ..functions import jsontext, measures, text, timefmt
from ..operators import dims, filters, metrics, routing, splitting, windows
from ..operators.joins import PAID_COLUMNS
from ..sinks import lifecycle
from ..sources import cdc, config, logs, readers
from . import changelog, joins, stateful
from .site import CHANGE_ORDER, Site

Queries = list[StreamingQuery]


# Dimensions and fact routing ------------------------------------------------------------------------

def dimensions(site: Site) -> Queries:
    """Changes of configured tables into the dimension store."""
    changes = cdc.cdc_clean_dim(cdc.read_cdc_envelope(readers.drop_tombstones(site.lines(fixed.TOPIC_DB)), None))
    store = site.dim_store()

    def act(batch: DataFrame, batch_id: int) -> None:
        current = config.config_latest(site.config("table_process_dim"))
        store.write(routing.prune_sink_columns(routing.route_dims(batch, current)), batch_id)
        if batch_id % site.fold_every == site.fold_every - 1:
            # One row per configured table; from now on readers start at the folded state.
            for row in current.select("sink_table", "sink_columns", "sink_row_key").distinct().toLocalIterator():
                store.fold(row.sink_table, row.sink_row_key or "id", row.sink_columns.split(","), batch_id)

    return [site.each_batch(changes.select("table", "type", *CHANGE_ORDER, "data"), "dim", act)]


def config_tables(site: Site, topics: Sequence[tuple[str, str]] = (
        ("table_process_dim", schemas.DIM_CONFIG), ("table_process_dwd", schemas.FACT_CONFIG))) -> Queries:
    """Config changes into the tables that the routing jobs read."""
    def follow(name: str, row: str) -> StreamingQuery:
        changes = cdc.parse_tolerant(readers.drop_tombstones(site.lines(name)), schemas.config_change(row))
        return site.each_batch(config.cdc_before_after(changes), f"config_{name}",
                               lambda batch, batch_id: site.config_table(name).write(batch, batch_id))

    return [follow(name, row) for name, row in topics]


def dim_tables(site: Site, topic: str = "table_process_dim", database: str = "default") -> Queries:
    """Create, recreate and drop catalog tables as their config rows come and go; a changed or removed config row also
    clears the stored dimension."""
    store = site.dim_store()
    changes = cdc.parse_tolerant(readers.drop_tombstones(site.lines(topic)), schemas.config_change(schemas.DIM_CONFIG))

    def act(batch: DataFrame, batch_id: int) -> None:
        rows = config.cdc_before_after(batch)
        for name in lifecycle.apply_lifecycle(site.spark, rows, database=database):
            store.clear(name)

    return [site.each_batch(changes, "dim_tables", act)]


def base_db(site: Site) -> Queries:
    """Inserts of configured tables to their fact topics."""
    changes = cdc.cdc_clean_fact(cdc.read_cdc_envelope(readers.drop_tombstones(site.lines(fixed.TOPIC_DB)), None))

    def act(batch: DataFrame, batch_id: int) -> None:
        current = config.config_latest(site.config("table_process_dwd"), config.FACT_KEY)
        routed = routing.route_by_config(batch, current, "fact")
        rows = routed.select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))
        if site.kafka:
            rows.write.format("kafka").options(**site.kafka).save()
        else:
            # A folder per batch: a repeated batch replaces what its first try left.
            rows.write.mode("overwrite").partitionBy("topic").text(f"{site.root}/topics/base_db-{batch_id}")

    return [site.each_batch(changes, "base_db", act)]


# Logs -----------------------------------------------------------------------------------------------

def base_log(site: Site) -> Queries:
    """Log lines to the dirty, error, start, play, display, action and page topics, in one query.

    Of a line the state needs device, flag and time; the line itself goes along as text. A line without device or time
    has no state to correct it by, and a dirty one has neither.
    """
    lines = jsontext.with_once(readers.drop_tombstones(site.lines(fixed.TOPIC_LOG)), "rec", F.from_json(
        "value", "common struct<mid:string,is_new:string>, ts string"))
    flat = lines.select("value", "rec.common.mid", "rec.common.is_new", F.col("rec.ts").try_cast("bigint").alias("ts"))
    known = stateful.fix_is_new(flat).select("value", "is_new")
    return [site.publish(splitting.split_log(known, dirty=True), "base_log")]


def _page_lines(site: Site) -> DataFrame:
    """Page records as text with the fields that state needs."""
    parsed = jsontext.parse(readers.drop_tombstones(site.lines(fixed.LOG_PAGE)), schemas.PAGE_LOG)
    return parsed.where(~jsontext.is_bad()).select("rec.common.mid", "rec.page.last_page_id", "rec.ts", "value")


def unique_visitors(site: Site) -> Queries:
    rows = stateful.unique_visitor_daily(_page_lines(site))
    return [site.publish(rows.select(F.lit(fixed.FACT_UNIQUE_VISITOR).alias("topic"), "value"), "unique_visitor")]


def user_jumps(site: Site) -> Queries:
    rows = stateful.user_jump(_page_lines(site))
    return [site.publish(rows.select(F.lit(fixed.FACT_USER_JUMP).alias("topic"), "value"), "user_jump")]


def logins(site: Site) -> Queries:
    pages = logs.read_page_log(site.lines(fixed.LOG_PAGE))
    flat = filters.flatten_login(filters.filter_login_pages(pages)).withColumn("uid", F.col("user_id"))
    first = stateful.first_login(flat, "mid_id").drop("uid")
    return [site.publish_json(first, fixed.FACT_LOGIN, "user_login")]


def _plays(site: Site) -> DataFrame:
    videos = cdc.parse_tolerant(readers.drop_tombstones(site.lines(fixed.LOG_VIDEO)), schemas.LOG)
    return logs.flatten_play(videos)


def study_plays(site: Site, gap: str = fixed.SESSION_GAP) -> Queries:
    return [site.publish_json(windows.session_stream(_timed(_plays(site), "ms"), gap), fixed.FACT_STUDY_PLAY, "study_play")]


# Trade facts ----------------------------------------------------------------------------------------

def _changes(site: Site) -> DataFrame:
    return cdc.read_cdc_envelope(readers.drop_tombstones(site.lines(fixed.TOPIC_DB)), None)


def _timed(df: DataFrame, unit: str, delay: str = fixed.DELAY_LONG) -> DataFrame:
    return windows.watermarked(timefmt.with_event_time(df, unit), delay)


def order_details(site: Site, bound: str = fixed.ORDER_JOIN_BOUND) -> Queries:
    """Order lines with their order and source, keyed by line. Partners may be `bound` away."""
    changes = _changes(site)
    detail, info = _timed(cdc.extract_order_detail(changes), "s"), _timed(cdc.extract_order_info(changes), "s")
    log = logs.extract_order_log(logs.read_page_log(site.lines(fixed.LOG_PAGE)))
    orders = joins.join_detail_order(detail, info, bound)
    facts = joins.join_order_source(orders, _timed(log, "ms"), bound)
    return [site.publish_json(facts.select(*_names(schemas.ORDER_DETAIL)), fixed.FACT_ORDER_DETAIL, "order_detail", "id")]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def payments(site: Site, types: tuple[str, ...] = (fixed.INSERT,), bound: str = fixed.ORDER_JOIN_BOUND) -> Queries:
    """Payments with the last line of their order, keyed by payment."""
    paid = _timed(cdc.extract_payment(_changes(site), types), "s")
    detail = site.facts(fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL).select("id", "order_id", *PAID_COLUMNS, "ts")
    facts = joins.join_payment_detail(paid, _timed(detail, "s"), bound)
    return [site.publish_json(facts.select(*_names(schemas.PAYMENT_DETAIL)), fixed.FACT_PAYMENT, "payment", "id")]


def registers(site: Site, bound: str = fixed.REGISTER_JOIN_BOUND) -> Queries:
    """Registrations with the user's last page attributes, keyed by user."""
    users = _timed(cdc.extract_user_register(_changes(site)), "s")
    log = logs.extract_dim_log(logs.read_page_log(site.lines(fixed.LOG_PAGE)))
    facts = joins.join_register_dim(users, _timed(log, "ms"), bound).drop("event_time")
    return [site.publish_json(facts.withColumn("row_op_ts", F.current_timestamp()), fixed.FACT_REGISTER, "user_register", "user_id")]


# Fact tables: rows come at once and are corrected when their partners do. ----------------------------------------------

def order_detail_table(site: Site, idle: int = fixed.ORDER_IDLE_MS, salts: int = 8) -> Queries:
    changes = _changes(site)
    log = logs.extract_order_log(logs.read_page_log(site.lines(fixed.LOG_PAGE)))
    rows = changelog.order_detail(cdc.extract_order_detail(changes), cdc.extract_order_info(changes), log,
                                  idle if site.forgets else None, salts)
    return [site.upsert(rows, fixed.FACT_ORDER_DETAIL)]


def payment_table(site: Site, types: tuple[str, ...] = (fixed.INSERT,), idle: int = fixed.ORDER_IDLE_MS) -> Queries:
    """Payments with the last line of their order, as the order detail topic has it by now."""
    detail = site.facts(fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL).select("id", "order_id", *PAID_COLUMNS, "ts")
    rows = changelog.payment_detail(cdc.extract_payment(_changes(site), types), detail, idle if site.forgets else None)
    return [site.upsert(rows, fixed.FACT_PAYMENT)]


def register_table(site: Site, idle: int = fixed.REGISTER_IDLE_MS) -> Queries:
    log = logs.extract_dim_log(logs.read_page_log(site.lines(fixed.LOG_PAGE)))
    rows = changelog.register_dim(cdc.extract_user_register(_changes(site)), log, idle if site.forgets else None)
    return [site.upsert(rows, fixed.FACT_REGISTER)]


# Metrics --------------------------------------------------------------------------------------------

def _windows(rows: DataFrame, delay: str, keys, measures, size: str = fixed.METRIC_WINDOW, cur_date: bool = True) -> DataFrame:
    return windows.windowed_metric(windows.watermarked(rows, delay), keys, measures, size, cur_date)


def _in_millis(facts: DataFrame) -> DataFrame:
    return facts.withColumn("ts", F.col("ts") * 1000)


def keyword(site: Site, tokenizer=text.words) -> Queries:
    pages = logs.read_page_log(site.lines(fixed.LOG_PAGE))
    return [site.metric(metrics.keyword(_timed(pages, "ms", fixed.DELAY_SHORT), tokenizer=tokenizer), fixed.METRIC_KEYWORD)]


def _pages(site: Site, topic: str) -> DataFrame:
    return logs.read_page_log(site.lines(topic))


def traffic(site: Site) -> Queries:
    rows = metrics.traffic_rows(
        _pages(site, fixed.LOG_PAGE), _pages(site, fixed.FACT_UNIQUE_VISITOR), _pages(site, fixed.FACT_USER_JUMP))
    summed = _windows(rows, fixed.DELAY_SHORT, [*metrics.TRAFFIC_KEYS], metrics.TRAFFIC_MEASURES)

    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_two_keys(batch, site.dim("dim_base_source", "source_site"), site.dim("dim_base_province", "name")
                                 ).drop("source_id", "province_id")

    return [site.metric(summed, fixed.METRIC_TRAFFIC, names)]


def page_view(site: Site, keys: tuple[str, ...] = ("mid", "page_id")) -> Queries:
    seen = filters.filter_three_pages(_pages(site, fixed.LOG_PAGE)).select("common.mid", "page.page_id", "ts")
    first = stateful.daily_first(seen, list(keys), ttl_ms=fixed.STATE_TTL_MS)
    counted = first.select("event_time", *[F.when(F.col("page_id") == page, 1).otherwise(0).alias(name)
                                           for name, page in metrics.PAGE_MEASURES.items()])
    return [site.metric(windows.windowed_metric(counted, [], [*metrics.PAGE_MEASURES]), fixed.METRIC_PAGE_VIEW)]


def chapter_play(site: Site, user_key: tuple[str, ...] = ("user_id", "video_id")) -> Queries:
    """Plays pass no state; of a user's plays the state sees the first of each day and task batch."""
    plays = _plays(site).select("user_id", "video_id", "play_sec", "ts")
    played = _timed(plays, "ms").select("event_time", "video_id", F.lit(1).alias("play_count"),
                                        F.col("play_sec").alias("play_total_sec"), F.lit(0).alias("play_uu_count"))
    known = filters.filter_required_keys(plays.select("user_id", "video_id", "ts"), "user_id")
    first = stateful.daily_first(known, list(user_key), ttl_ms=fixed.STATE_TTL_MS)
    users = first.select("event_time", "video_id", F.lit(0).alias("play_count"), F.lit(0).alias("play_total_sec"),
                         F.lit(1).alias("play_uu_count"))
    summed = windows.windowed_metric(played.unionByName(users), ["video_id"], ["play_count", "play_total_sec", "play_uu_count"],
                                     cur_date=False)

    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_chain_2(batch, site.dim("dim_video_info", "chapter_id"), site.dim("dim_chapter_info", "chapter_name"))

    return [site.metric(summed, fixed.METRIC_CHAPTER_PLAY, names)]


def user_login(site: Site) -> Queries:
    rows = site.facts(fixed.FACT_LOGIN, schemas.LOGIN).select("user_id", "ts")
    first = stateful.daily_first(rows, ["user_id"])
    counted = first.select("event_time", F.lit(1).alias("uv_count"), stateful.is_back().alias("back_count"))
    return [site.metric(windows.windowed_metric(counted, [], ["uv_count", "back_count"]), fixed.METRIC_LOGIN)]


def user_register(site: Site) -> Queries:
    rows = timefmt.with_event_time(site.facts(fixed.FACT_REGISTER, schemas.REGISTER), "s").select("event_time", F.lit(1).alias("register_count"))
    return [site.metric(_windows(rows, fixed.DELAY_LONG, [], ["register_count"], cur_date=False), fixed.METRIC_REGISTER)]


def cart_add(site: Site) -> Queries:
    carts = _in_millis(site.facts(fixed.FACT_CART_ADD, schemas.CART_ADD)).select("user_id", "ts")
    first = stateful.daily_first(carts, ["user_id"], fixed.DELAY_SHORT, fixed.STATE_TTL_MS)
    rows = first.select("event_time", F.lit(1).alias("cart_add_uv_count"))
    return [site.metric(windows.windowed_metric(rows, [], ["cart_add_uv_count"]), fixed.METRIC_CART_ADD)]


def _daily_users(facts: DataFrame, uv: str, new: str) -> DataFrame:
    first = stateful.daily_first(_in_millis(facts).select("user_id", "ts"), ["user_id"])
    rows = first.select("event_time", F.lit(1).alias(uv), stateful.is_new_user().alias(new))
    return windows.windowed_metric(rows, [], [uv, new])


def order_users(site: Site) -> Queries:
    facts = filters.filter_required_keys(site.facts(fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL), "user_id")
    return [site.metric(_daily_users(facts, "order_uv_count", "new_order_user_count"), fixed.METRIC_ORDER_USERS)]


def pay_users(site: Site) -> Queries:
    facts = filters.filter_required_keys(site.facts(fixed.FACT_PAYMENT, schemas.PAYMENT_DETAIL), "user_id")
    return [site.metric(_daily_users(facts, "pay_suc_uv_count", "pay_suc_new_user_count"), fixed.METRIC_PAY_USERS)]


def course_orders(site: Site) -> Queries:
    facts = timefmt.with_event_time(site.facts(fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL), "s")
    rows = facts.select("event_time", "course_id", measures.money(F.col("final_amount")).alias("order_total_amount"))
    summed = _windows(rows, fixed.DELAY_LONG, ["course_id"], {"order_total_amount": measures.SUM})

    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_snowflake_3(batch, site.dim("dim_course_info", "course_name", "subject_id"),
                                    site.dim("dim_base_subject_info", "subject_name", "category_id"),
                                    site.dim("dim_base_category_info", "category_name"))

    return [site.metric(summed, fixed.METRIC_COURSE_ORDERS, names)]


def _order_group(site: Site, group: str, size: str) -> DataFrame:
    """Amounts of all lines, and the first lines of the day of orders and of users within the group.

    Amounts pass no state; an order belongs to one group. State forgets an order or user after a day.
    """
    lines = filters.filter_required_keys(site.facts(fixed.FACT_ORDER_DETAIL, schemas.ORDER_DETAIL), "user_id", group)
    slim = _in_millis(lines).select("order_id", "user_id", group, "final_amount", "ts")
    none, one, amount = F.lit(0), F.lit(1), "decimal(18,2)"

    def rows(df: DataFrame, total, orders, users) -> DataFrame:
        return df.select("event_time", group, total.cast(amount).alias("order_total_amount"), orders.alias("order_count"),
                         users.alias("order_uu_count"))

    def first(key: str) -> DataFrame:
        return stateful.daily_first(slim.select(key, group, "ts"), [key, group], ttl_ms=fixed.STATE_TTL_MS)

    parts = rows(_timed(slim, "ms"), measures.money(F.col("final_amount")), none, none)
    parts = parts.unionByName(rows(first("order_id"), none, one, none)).unionByName(rows(first("user_id"), none, none, one))
    return windows.windowed_metric(parts, [group], metrics.ORDER_GROUP_MEASURES, size)


def source_orders(site: Site) -> Queries:
    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_lookup(batch, site.dim("dim_base_source", "source_site"), "source_id", {"source_site": "source_name"})

    return [site.metric(_order_group(site, "source_id", fixed.METRIC_WINDOW), fixed.METRIC_SOURCE_ORDERS, names)]


def province_orders(site: Site) -> Queries:
    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_lookup(batch, site.dim("dim_base_province", "name"), "province_id", {"name": "province_name"})

    return [site.metric(_order_group(site, "province_id", fixed.PROVINCE_WINDOW), fixed.METRIC_PROVINCE_ORDERS, names)]


def course_review(site: Site) -> Queries:
    rows = metrics.review_rows(site.facts(fixed.FACT_REVIEW, schemas.REVIEW))
    summed = _windows(rows, fixed.DELAY_LONG, ["course_id"], metrics.REVIEW_MEASURES)

    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_lookup(batch, site.dim("dim_course_info", "course_name"), "course_id", {"course_name": "course_name"})

    return [site.metric(summed, fixed.METRIC_REVIEW, names)]


def exam_paper(site: Site) -> Queries:
    rows = metrics.paper_rows(site.facts(fixed.FACT_EXAM_PAPER, schemas.EXAM_PAPER))
    summed = _windows(rows, fixed.DELAY_LONG, ["paper_id"], metrics.PAPER_MEASURES)

    def names(batch: DataFrame) -> DataFrame:
        titled = dims.dim_lookup(batch, site.dim("dim_test_paper", "paper_title", "course_id"), "paper_id",
                                 {"paper_title": "paper_title", "course_id": "course_id"})
        return dims.dim_lookup(titled, site.dim("dim_course_info", "course_name"), "course_id", {"course_name": "course_name"})

    return [site.metric(summed, fixed.METRIC_EXAM_PAPER, names)]


def exam_score(site: Site) -> Queries:
    rows = metrics.score_rows(site.facts(fixed.FACT_EXAM_PAPER, schemas.EXAM_PAPER))
    summed = _windows(rows, fixed.DELAY_LONG, ["paper_id", "score_duration"], ["user_count"])

    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_lookup(batch, site.dim("dim_test_paper", "paper_title"), "paper_id", {"paper_title": "paper_title"})

    return [site.metric(summed, fixed.METRIC_EXAM_SCORE, names)]


def exam_question(site: Site) -> Queries:
    rows = metrics.question_rows(site.facts(fixed.FACT_EXAM_QUESTION, schemas.EXAM_QUESTION))
    summed = _windows(rows, fixed.DELAY_LONG, ["question_id"], metrics.QUESTION_MEASURES)

    def names(batch: DataFrame) -> DataFrame:
        return dims.dim_lookup(batch, site.dim("dim_test_question_info", "question_txt"), "question_id",
                               {"question_txt": "question_txt"})

    return [site.metric(summed, fixed.METRIC_EXAM_QUESTION, names)]


# In the order in which each layer feeds the next.
CONFIG_JOBS = {"config_tables": config_tables, "dim_tables": dim_tables}
DIMENSION_JOBS = {"dimensions": dimensions}
LOG_JOBS = {"base_log": base_log, "base_db": base_db}
FACT_JOBS = {"unique_visitors": unique_visitors, "user_jumps": user_jumps, "logins": logins, "study_plays": study_plays,
             "order_details": order_details, "registers": registers}
PAYMENT_JOBS = {"payments": payments}
METRIC_JOBS = {
    "keyword": keyword, "traffic": traffic, "page_view": page_view, "chapter_play": chapter_play, "user_login": user_login,
    "user_register": user_register, "cart_add": cart_add, "order_users": order_users, "pay_users": pay_users,
    "course_orders": course_orders, "source_orders": source_orders, "province_orders": province_orders,
    "course_review": course_review, "exam_paper": exam_paper, "exam_score": exam_score, "exam_question": exam_question,
}
TABLE_JOBS = {"order_detail_table": order_detail_table, "payment_table": payment_table, "register_table": register_table}
LAYERS = [CONFIG_JOBS, DIMENSION_JOBS, LOG_JOBS, FACT_JOBS, PAYMENT_JOBS, TABLE_JOBS, METRIC_JOBS]
