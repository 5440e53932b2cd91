"""Logical inputs of the registered queries, mapped from the given tables.

The mapping of each input is also written as SQL in inputs_sql.py.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import jsontext, measures, timefmt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _with_numbers(events: DataFrame) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.unix_millis(at).alias("ts"), F.unix_seconds(at).alias("ts_s"),
        F.date_format(at, timefmt.DATE).alias("day"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_numbers(table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return _with_numbers(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def _prefixed(prefix: str, modulus: int) -> Column:
    return F.concat(F.lit(prefix), text(F.col("k") % modulus))


def session_of(user: Column, day: Column) -> Column:
    return F.concat(text(user), F.lit("-"), day)


def common() -> Column:
    return F.struct(
        text(F.col("k") % 5).alias("sc"), text(F.col("k") % 25).alias("ar"),
        F.when(F.col("k") % 10 != 0, text("user_id")).alias("uid"),
        _prefixed("os", 2).alias("os"), _prefixed("ch", 4).alias("ch"),
        F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"),
        _prefixed("md", 7).alias("md"), text("user_id").alias("mid"), _prefixed("v", 3).alias("vc"),
        _prefixed("ba", 6).alias("ba"), session_of(F.col("user_id"), F.col("day")).alias("sid"))


def page() -> Column:
    kind = F.col("event_type")
    return F.struct(
        F.when(kind == "view", "home").when(kind == "click", "course_list")
        .when(kind == "signup", "course_detail").otherwise("order").alias("page_id"),
        _prefixed("item", 10).alias("item"),
        F.floor(F.col("value") * 1000).alias("during_time"), F.lit("course_id").alias("item_type"),
        F.when(~kind.isin("view", "signup"), "home").alias("last_page_id"))


def pages_of(events_df: DataFrame) -> DataFrame:
    """Page records: every event that is no error."""
    return events_df.where(F.col("event_type") != "error").select(
        common().alias("common"), page().alias("page"), "ts", "event_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_of(events(spark, sf_dir))


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages: every document text is searched once, one a second."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.struct(F.col("text").alias("item"), F.lit("keyword").alias("item_type")).alias("page"),
        (F.lit(1704067200000) + F.col("doc_id") * 1000).alias("ts"))


def videos_of(events_df: DataFrame) -> DataFrame:
    """Play records: every click."""
    return events_df.where(F.col("event_type") == "click").select(
        common().alias("common"),
        F.struct(F.floor("value").cast("int").alias("play_sec"), text("k").alias("video_id"),
                 F.col("k").alias("position_sec")).alias("appVideo"), "ts")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return videos_of(events(spark, sf_dir))


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed log records: errors, starts, plays and pages with displays and actions."""
    ev = events(spark, sf_dir)
    kind, k = F.col("event_type"), F.col("k")
    start = k % 7 == 0
    video = ~start & (kind == "click") & (k % 3 == 0)
    on_page = ~start & ~video
    display = F.transform(F.sequence(F.lit(1), k % 4), lambda i: F.struct(
        F.lit("query").alias("display_type"), text(i).alias("item"), F.lit("course_id").alias("item_type"),
        i.alias("pos_id"), i.alias("order")))
    return ev.select(
        "event_id", "k", common().alias("common"),
        F.when(on_page, page()).alias("page"),
        F.when(on_page & (kind == "view") & (k % 4 > 0), display).alias("displays"),
        F.when(on_page & (kind == "purchase"), F.array(
            F.create_map(F.lit("action_id"), F.lit("pay"), F.lit("item"), text("k")))).alias("actions"),
        F.when(start, F.struct(F.lit("icon").alias("entry"), k.alias("loading"))).alias("start"),
        F.when(kind == "error", F.struct(k.alias("code"))).alias("err"),
        F.when(video, F.struct(F.floor("value").cast("int").alias("play_sec"), text("k").alias("video_id"),
                               k.alias("position_sec"))).alias("appVideo"),
        "ts")


def log_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as JSON text. k = 99 lines are cut short, k = 98 lines empty, k = 97 lines null.

    Of every fifth event the line has numbers as text and fields that no schema knows.
    """
    records = log_records(spark, sf_dir)
    line = F.to_json(F.struct("common", "page", "displays", "actions", "start", "err", "appVideo", "ts"))
    odd = F.regexp_replace(line, r'"(ts|during_time|play_sec)":(\d+)', r'"$1":"$2"')
    odd = F.concat(F.lit('{"trace":{"id":"t'), text("k"), F.lit('"},"common":{"net":"5g",'), F.substr(odd, F.lit(12)))
    line = F.when((F.col("event_id") % 5 == 0) & (F.col("k") < 97), odd).otherwise(line)
    value = F.when(F.col("k") == 99, F.substring(line, 1, 40)).when(F.col("k") == 98, "").when(F.col("k") < 97, line)
    return jsontext.with_once(records, "value", value).select("event_id", "value")


def cents(column) -> Column:
    return measures.money(F.col(column))


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
    key = F.col("o_orderkey")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")), timefmt.DATE)
    return joined.select(
        text(key).alias("id"), text("o_custkey").alias("user_id"),
        F.concat(F.lit("T"), text(key)).alias("out_trade_no"), F.col("o_orderpriority").alias("trade_body"),
        session_of(F.floor(F.col("o_custkey") / 10), day).alias("session_id"),
        text("c_nationkey").alias("province_id"),
        (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + key % 86400).alias("ts"))


def _with_texts(df: DataFrame) -> DataFrame:
    """create_time and create_date as text, from ts."""
    at = F.timestamp_seconds("ts")
    return df.withColumns({"create_time": F.date_format(at, timefmt.DATETIME), "create_date": F.date_format(at, timefmt.DATE)})


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_texts(_order_lines(spark, sf_dir))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    ts = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + (key * 37 + line) % 86400
    price, rate = cents("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(text(key), F.lit("-"), text(line)).alias("id"), text("l_suppkey").alias("course_id"),
        F.concat(F.lit("Course "), text("l_suppkey")).alias("course_name"), text(key).alias("order_id"),
        text(key % 997).alias("user_id"), price.alias("origin_amount"),
        measures.money(price * rate).alias("coupon_reduce"),
        measures.money(price * (F.lit(1).cast("decimal(4,2)") - rate)).alias("final_amount"), ts.alias("ts"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    ts = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + key % 86400
    stamp = F.date_format(F.timestamp_seconds(ts), timefmt.DATETIME)
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("P"), text(key)).alias("id"), F.concat(F.lit("T"), text(key)).alias("out_trade_no"),
        text(key).alias("order_id"), F.concat(F.lit("A"), text(key)).alias("alipay_trade_no"),
        cents("o_totalprice").alias("total_amount"), F.col("o_orderpriority").alias("trade_body"),
        F.concat(F.lit("110"), text(key % 2)).alias("payment_type"), F.lit("1602").alias("payment_status"),
        stamp.alias("create_time"), F.date_format(F.timestamp_seconds(ts), timefmt.DATE).alias("create_date"),
        stamp.alias("callback_time"), ts.alias("ts"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.logs import extract_order_log

    return extract_order_log(pages(spark, sf_dir))


def orders_fact(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines with province and source, as the order detail job writes them; all columns or some."""
    from ..operators.joins import order_detail_fact

    facts = order_detail_fact(_order_lines(spark, sf_dir), order_info(spark, sf_dir), order_log(spark, sf_dir), columns)
    # The texts depend on ts alone, so they are written for the rows that stay.
    return facts if columns else _with_texts(facts)


def payments_fact(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    from ..operators.joins import PAID_COLUMNS, payment_fact

    needed = ["id", "order_id", "ts", *[c for c in PAID_COLUMNS if not columns or c in columns]]
    return payment_fact(payments(spark, sf_dir), orders_fact(spark, sf_dir, *needed), columns)


def registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations: every signup event; a user registers with the first."""
    from ..operators.firsts import first_per

    rows = events(spark, sf_dir).where(F.col("event_type") == "signup").select(
        text("user_id").alias("id"), F.date_format(F.timestamp_seconds("ts_s"), timefmt.DATETIME).alias("create_time"),
        F.col("day").alias("create_date"), F.col("ts_s").alias("ts"))
    return first_per(rows, ["id"], ["ts"])


def carts_of(events_df: DataFrame) -> DataFrame:
    return events_df.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("id"), F.col("k").cast("bigint").alias("course_id"), "user_id",
        cents("value").alias("cart_price"), F.col("ts_s").alias("ts"))


def reviews_of(events_df: DataFrame) -> DataFrame:
    return events_df.select(
        F.col("event_id").alias("id"), "user_id", text("k").alias("course_id"),
        (F.col("k") % 5 + 1).cast("bigint").alias("review_stars"), F.col("ts_s").alias("ts"))


def exams_of(events_df: DataFrame) -> DataFrame:
    return events_df.select(
        F.col("event_id").alias("id"), text(F.col("user_id") % 10).alias("paper_id"), "user_id",
        F.col("value").alias("score"), (F.col("k") * 10).cast("bigint").alias("duration_sec"), F.col("ts_s").alias("ts"))


def answers_of(events_df: DataFrame) -> DataFrame:
    return events_df.select(
        F.col("event_id").alias("id"), text("k").alias("question_id"), text(F.col("event_id") % 2).alias("is_correct"),
        F.col("ts_s").alias("ts"))


# Change records -------------------------------------------------------------------------------------

def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records from events: one table per event type, some of them unclean."""
    kind, k = F.col("event_type"), F.col("k")
    source = (F.when(kind == "click", "cart_info").when(kind == "view", "review_info")
              .when(kind == "signup", "favor_info").when(kind == "purchase", "test_exam").otherwise("comment_info"))
    row_type = (F.when(kind == "click", "insert").when(kind == "view", "update")
                .when(kind == "signup", "bootstrap-insert").when(kind == "purchase", "insert").otherwise("other"))
    row = F.map_from_arrays(
        F.array(F.lit("id"), F.lit("user_id"), F.lit("course_id"), F.lit("extra")),
        F.array(text("event_id"), text("user_id"), text("k"), F.concat(F.lit("x"), text("k"))))
    short = F.map_filter(row, lambda key, value: key == "id")
    return events(spark, sf_dir).select(
        F.when(k % 10 == 9, "other").otherwise("edu").alias("database"), source.alias("table"),
        row_type.alias("type"), F.col("ts_s").alias("ts"), F.when(k % 8 == 0, short).otherwise(row).alias("data"))


def _map_of(df: DataFrame, columns) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[text(c) for c in columns]))


def _envelope(df: DataFrame, name: str, columns) -> DataFrame:
    return df.select(F.lit("edu").alias("database"), F.lit(name).alias("table"), F.lit("insert").alias("type"),
                     "ts", _map_of(df, columns).alias("data"))


def trade_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert records of order_info, order_detail, payment_info and user_info."""
    from ..sources import cdc

    lines = _envelope(order_detail(spark, sf_dir), "order_detail", cdc.ORDER_DETAIL)
    orders = _envelope(order_info(spark, sf_dir), "order_info", cdc.ORDER_INFO)
    paid = _envelope(payments(spark, sf_dir), "payment_info", cdc.PAYMENT)
    users = _envelope(registers(spark, sf_dir), "user_info", ("id", "create_time"))
    return lines.unionByName(orders).unionByName(paid).unionByName(users)


def as_topic(changes: DataFrame) -> DataFrame:
    """Change records as JSON text; a third of them have the time as text, as one of the readers has it."""
    line = F.to_json(F.struct(*changes.columns))
    line = F.when(F.col("ts") % 3 == 0, F.regexp_replace(line, r'"ts":(\d+)', r'"ts":"$1"')).otherwise(line)
    return jsontext.with_once(changes, "value", line).select("value")


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config change records: one source table per user, rewritten and removed by later events."""
    kind = F.col("event_type")
    row = F.struct(
        F.concat(F.lit("t"), text("user_id")).alias("source_table"),
        F.concat(F.lit("dim_"), text("k")).alias("sink_table"), F.concat(F.lit("id,c"), text("k")).alias("sink_columns"))
    op = F.when(kind == "error", "d").when(kind == "view", "u").when(kind == "signup", "c").otherwise("r")
    return events(spark, sf_dir).select(
        F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after"), op.alias("op"),
        F.col("ts").alias("ts_ms"), "event_id")


def user_dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a user dimension: clicks set the level, views the score, errors delete the user."""
    kind, k = F.col("event_type"), F.col("k")
    row_type = (F.when(kind == "error", "delete").when(kind == "signup", "insert").otherwise("update"))
    level = F.when(kind.isin("click", "signup"), F.concat(F.lit("level"), text(k % 10)))
    score = F.when(kind.isin("view", "signup"), text("k"))
    row = F.map_from_arrays(F.array(F.lit("id"), F.lit("level"), F.lit("score")), F.array(text("user_id"), level, score))
    return events(spark, sf_dir).select(row_type.alias("type"), "ts", "event_id", row.alias("data"))


# Dimensions -----------------------------------------------------------------------------------------

def dim_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def dim_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(text("r_regionkey").alias("id"), F.col("r_name").alias("source_site"))


def dim_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("id"), F.col("s_name").alias("course_name"), text("s_nationkey").alias("subject_id"))


def dim_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        text("n_nationkey").alias("id"), F.col("n_name").alias("subject_name"), text("n_regionkey").alias("category_id"))


def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(text("r_regionkey").alias("id"), F.col("r_name").alias("category_name"))


def dim_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(text("p_partkey").alias("id"), F.col("p_brand").alias("chapter_id"))


def dim_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("id")).distinct().select(
        "id", F.concat(F.lit("Chapter "), F.col("id")).alias("chapter_name"))


def dim_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("id"), F.concat(F.lit("Paper "), F.col("s_name")).alias("paper_title"),
        text("s_nationkey").alias("course_id"))


def dim_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(text("p_partkey").alias("id"), F.col("p_name").alias("question_txt"))


def dim_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        text("n_nationkey").alias("dic_code"), F.struct(F.col("n_name").alias("dic_name")).alias("info"))
