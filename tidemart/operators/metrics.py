"""The metric tables: row measures, window sums, then dimension names.

Daily-unique measures come in as rows of their own (the first row per key and day) that are added to
the union before the one window aggregation. So no metric ranks the rows of a key, and names are looked
up for result rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from ..functions import measures, text, timefmt
from . import dims, filters, firsts, visitors, windows
from .windows import windowed_metric


def _rows(df: DataFrame, unit: str, keys: dict, values: dict) -> DataFrame:
    """Event time, key columns and measure columns of a fact."""
    timed = timefmt.with_event_time(df, unit)
    return timed.select("event_time", *[F.col(c).alias(k) for k, c in keys.items()],
                        *[v.alias(k) for k, v in values.items()])


def _union(keys: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Union of rows that carry different measures; the missing ones are 0."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.fillna(0, [c for c in out.columns if c not in ("event_time", *keys)])


def keyword(searches: DataFrame, size: str = fixed.METRIC_WINDOW, tokenizer=text.words) -> DataFrame:
    """Words of search texts. Words are counted per window in SQL, as a table function would be."""
    asked = searches.where(F.col("page.item").isNotNull() & (F.col("page.item_type") == fixed.KEYWORD_ITEM))
    # A stream comes with event_time and its watermark.
    timed = asked if "event_time" in asked.columns else timefmt.with_event_time(asked, "ms")
    timed = timed.select("event_time", F.col("page.item").alias("full_word"))
    split = text.tokenize_explode(timed, "full_word", "keyword", tokenizer)
    counted = windows.tumble_tvf(split, ["keyword"], "keyword_count", size)
    return counted.withColumn("source", F.lit(fixed.KEYWORD_SOURCE))


TRAFFIC_KEYS = {"version_code": "common.vc", "source_id": "common.sc", "province_id": "common.ar",
                "is_new": "common.is_new"}
TRAFFIC_MEASURES = ("uv_count", "total_session_count", "page_view_count", "total_during_time", "jump_session_count")


def traffic_rows(pages: DataFrame, visitors_daily: DataFrame, jumps: DataFrame) -> DataFrame:
    """Page, daily-visitor and jump measures in one row set."""
    entry = F.col("page.last_page_id").isNull()
    viewed = _rows(pages, "ms", TRAFFIC_KEYS, {
        "total_session_count": measures.indicator(entry), "page_view_count": F.lit(1),
        "total_during_time": F.col("page.during_time")})
    visited = _rows(visitors_daily, "ms", TRAFFIC_KEYS, {"uv_count": F.lit(1)})
    jumped = _rows(jumps, "ms", TRAFFIC_KEYS, {"jump_session_count": F.lit(1)})
    return _union([*TRAFFIC_KEYS], viewed, visited, jumped)


def traffic(pages: DataFrame, source: DataFrame, province: DataFrame, tie: Sequence[str] = (),
            size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Visitors, sessions, page views, time and jumps by version, source, province and new flag."""
    # Picking first rows carries whole rows through the shuffle, so only what is counted goes in.
    pages = pages.select(
        F.struct("common.mid", *TRAFFIC_KEYS.values()).alias("common"),
        F.struct("page.last_page_id", "page.during_time").alias("page"), "ts", *tie)
    rows = traffic_rows(pages, visitors.unique_visitor_daily(pages, tie), visitors.user_jump(pages, tie))
    summed = windowed_metric(rows, [*TRAFFIC_KEYS], TRAFFIC_MEASURES, size)
    return dims.dim_two_keys(summed, source, province).drop("source_id", "province_id")


PAGE_MEASURES = {"home_uv_count": fixed.PAGE_HOME, "list_uv_count": fixed.PAGE_LIST, "detail_uv_count": fixed.PAGE_DETAIL}


def page_daily_uv(pages: DataFrame, keys: Sequence[str] = ("mid", "page_id")) -> DataFrame:
    """Daily-unique devices of the three pages, one measure column per page.

    keys=('mid',) counts a device under the first of the pages it opens on a day only.
    """
    seen = filters.filter_three_pages(pages).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")
    # With the page in the key the first time is all that is needed; else the first row's page as well.
    if "page_id" in keys:
        first = firsts.daily_first_time(seen, list(keys))
    else:
        first = firsts.daily_first(seen, list(keys), ["ts"])
    counted = {name: measures.indicator(F.col("page_id") == page) for name, page in PAGE_MEASURES.items()}
    return _rows(first, "ms", {k: k for k in keys}, counted)


def page_view(pages: DataFrame, keys: Sequence[str] = ("mid", "page_id"), size: str = fixed.METRIC_WINDOW) -> DataFrame:
    return windowed_metric(page_daily_uv(pages, keys), [], [*PAGE_MEASURES], size)


def chapter_play(plays: DataFrame, video: DataFrame, chapter: DataFrame, user_key: Sequence[str] = ("user_id", "video_id"),
                 size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Plays, seconds and daily-unique users per chapter (by video). user_key=('user_id',) counts a
    user under one video a day. A play without user counts as a play, not as a user."""
    played = _rows(plays, "ms", {"video_id": "video_id"}, {"play_count": F.lit(1), "play_total_sec": F.col("play_sec")})
    watched = filters.filter_required_keys(plays.select("user_id", "video_id", "ts"), "user_id")
    if "video_id" in user_key:
        first = firsts.daily_first_time(watched, list(user_key))
    else:
        first = firsts.daily_first(watched, list(user_key), ["ts"])
    users = _rows(first, "ms", {"video_id": "video_id"}, {"play_uu_count": F.lit(1)})
    rows = _union(["video_id"], played, users)
    by_video = windowed_metric(rows, ["video_id"], ["play_count", "play_total_sec", "play_uu_count"], size, cur_date=False)
    return dims.dim_chain_2(by_video, video, chapter)


def user_login(logins: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Daily-unique and returning users."""
    rows = timefmt.with_event_time(visitors.login_uv_back(logins), "ms")
    return windowed_metric(rows, [], ["uv_count", "back_count"], size)


def user_register(registers: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    rows = _rows(registers, "s", {}, {"register_count": F.lit(1)})
    return windowed_metric(rows, [], ["register_count"], size, cur_date=False)


def cart_add(carts: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Users by their first cart addition of the day."""
    first = firsts.daily_first_time(carts, ["user_id"], unit="s")
    return windowed_metric(_rows(first, "s", {}, {"cart_add_uv_count": F.lit(1)}), [], ["cart_add_uv_count"], size)


def order_users(orders: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Ordering users per day, and users with their first order of all; orders without user drop out."""
    known = filters.filter_required_keys(orders, "user_id")
    rows = timefmt.with_event_time(visitors.user_daily_new(known), "s").withColumnsRenamed(
        {"uv_count": "order_uv_count", "new_count": "new_order_user_count"})
    return windowed_metric(rows, [], ["order_uv_count", "new_order_user_count"], size)


def pay_users(payments: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Paying users per day, and users with their first payment of all; payments without user drop out."""
    known = filters.filter_required_keys(payments, "user_id")
    rows = timefmt.with_event_time(visitors.user_daily_new(known), "s").withColumnsRenamed(
        {"uv_count": "pay_suc_uv_count", "new_count": "pay_suc_new_user_count"})
    return windowed_metric(rows, [], ["pay_suc_uv_count", "pay_suc_new_user_count"], size)


def course_orders(orders: DataFrame, course: DataFrame, subject: DataFrame, category: DataFrame,
                  size: str = fixed.METRIC_WINDOW) -> DataFrame:
    """Order amount per course with its subject and category."""
    rows = _rows(orders, "s", {"course_id": "course_id"}, {"order_total_amount": measures.money(F.col("final_amount"))})
    summed = windowed_metric(rows, ["course_id"], {"order_total_amount": measures.SUM}, size)
    return dims.dim_snowflake_3(summed, course, subject, category)


ORDER_GROUP_MEASURES = {"order_total_amount": measures.SUM, "order_uu_count": "bigint", "order_count": "bigint"}


def order_group_rows(orders: DataFrame, group: str, size: str) -> DataFrame:
    """Amounts per window, plus daily-first rows of orders and of users within a group.

    The three counts need three groupings. Each line takes part in all of them as one row each, so
    the lines, often the outcome of joins, are computed once and grouped in one shuffle, after a
    partial aggregation. Province and source belong to the order, so an order is in one group; with the
    group in the key, sums and least times are fixed-width values that a hash aggregate holds.
    """
    lines = timefmt.with_event_time(filters.filter_required_keys(orders, "user_id", group), "s")
    day = F.to_date("event_time").cast("timestamp")
    none = F.lit(None)

    def share(kind: str, owner, slot, amount=none):
        return F.struct(F.lit(kind).alias("kind"), owner.cast("string").alias("owner"), F.col(group).alias(group),
                        slot.alias("slot"), amount.cast("decimal(18,2)").alias("amount"), F.col("ts").alias("ts"))

    shares = lines.select(F.inline(F.array(
        share("amount", none, F.window("event_time", size)["start"], measures.money(F.col("final_amount"))),
        share("order", F.col("order_id"), day), share("user", F.col("user_id"), day))))
    grouped = shares.groupBy("kind", "owner", group, "slot").agg(
        F.sum("amount").alias("order_total_amount"), F.min("ts").alias("ts"))
    is_kind = {k: F.col("kind") == k for k in ("amount", "order", "user")}
    return grouped.select(
        F.when(is_kind["amount"], F.col("slot")).otherwise(F.timestamp_seconds("ts")).alias("event_time"), group,
        F.coalesce("order_total_amount", F.lit(0)).alias("order_total_amount"),
        measures.indicator(is_kind["order"]).alias("order_count"), measures.indicator(is_kind["user"]).alias("order_uu_count"))


def source_orders(orders: DataFrame, source: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    summed = windowed_metric(order_group_rows(orders, "source_id", size), ["source_id"], ORDER_GROUP_MEASURES, size)
    return dims.dim_lookup(summed, source, "source_id", {"source_site": "source_name"})


def province_orders(orders: DataFrame, province: DataFrame, size: str = fixed.PROVINCE_WINDOW) -> DataFrame:
    summed = windowed_metric(order_group_rows(orders, "province_id", size), ["province_id"], ORDER_GROUP_MEASURES, size)
    return dims.dim_lookup(summed, province, "province_id", {"name": "province_name"})


def review_rows(reviews: DataFrame) -> DataFrame:
    """Review measures; a review without stars drops out."""
    return _rows(filters.filter_required_keys(reviews, "review_stars"), "s", {"course_id": "course_id"}, {
        "review_total_stars": F.col("review_stars"), "review_user_count": F.lit(1),
        "good_review_user_count": measures.indicator(F.col("review_stars") == 5)})


REVIEW_MEASURES = ("review_total_stars", "review_user_count", "good_review_user_count")


def course_review(reviews: DataFrame, course: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    summed = windowed_metric(review_rows(reviews), ["course_id"], REVIEW_MEASURES, size)
    return dims.dim_lookup(summed, course, "course_id", {"course_name": "course_name"})


def paper_rows(exams: DataFrame) -> DataFrame:
    """Exam measures; the fraction of a score is cut off, an exam without score drops out."""
    return _rows(filters.filter_required_keys(exams, "score"), "s", {"paper_id": "paper_id"}, {
        "exam_taken_count": F.lit(1), "exam_total_score": F.col("score").cast("double").cast("bigint"),
        "exam_total_during_sec": F.col("duration_sec")})


PAPER_MEASURES = ("exam_taken_count", "exam_total_score", "exam_total_during_sec")


def exam_paper(exams: DataFrame, paper: DataFrame, course: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    summed = windowed_metric(paper_rows(exams), ["paper_id"], PAPER_MEASURES, size)
    titled = dims.dim_lookup(summed, paper, "paper_id", {"paper_title": "paper_title", "course_id": "course_id"})
    return dims.dim_lookup(titled, course, "course_id", {"course_name": "course_name"})


def score_rows(exams: DataFrame) -> DataFrame:
    scored = filters.filter_required_keys(exams, "score")
    bucketed = scored.withColumn("score_duration", measures.score_bucket(F.col("score").cast("double")))
    return _rows(bucketed, "s", {"paper_id": "paper_id", "score_duration": "score_duration"}, {"user_count": F.lit(1)})


def exam_score(exams: DataFrame, paper: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    summed = windowed_metric(score_rows(exams), ["paper_id", "score_duration"], ["user_count"], size)
    return dims.dim_lookup(summed, paper, "paper_id", {"paper_title": "paper_title"})


def question_rows(answers: DataFrame) -> DataFrame:
    return _rows(answers, "s", {"question_id": "question_id"}, {
        "answer_count": F.lit(1), "correct_answer_count": measures.indicator(F.col("is_correct") == "1")})


QUESTION_MEASURES = ("correct_answer_count", "answer_count")


def exam_question(answers: DataFrame, question: DataFrame, size: str = fixed.METRIC_WINDOW) -> DataFrame:
    summed = windowed_metric(question_rows(answers), ["question_id"], QUESTION_MEASURES, size)
    return dims.dim_lookup(summed, question, "question_id", {"question_txt": "question_txt"})
