"""The input mappings of inputs.py as DuckDB SQL, one common table expression each."""

from __future__ import annotations

STAMP = "'%Y-%m-%d %H:%M:%S'"

CTES = {
    "ev": """
      SELECT event_id, user_id, event_type, value, CAST(props->>'$.k' AS INTEGER) AS k,
             epoch_us(ts) // 1000 AS ts, epoch_us(ts) // 1000000 AS ts_s, strftime(ts, '%Y-%m-%d') AS day
      FROM events""",
    "common": """
      SELECT *, CAST(k % 5 AS VARCHAR) AS sc, CAST(k % 25 AS VARCHAR) AS ar,
             CASE WHEN k % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
             'os' || (k % 2) AS os, 'ch' || (k % 4) AS ch,
             CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
             'md' || (k % 7) AS md, CAST(user_id AS VARCHAR) AS mid, 'v' || (k % 3) AS vc,
             'ba' || (k % 6) AS ba, user_id || '-' || day AS sid,
             CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'course_list'
                  WHEN 'signup' THEN 'course_detail' ELSE 'order' END AS page_id,
             'item' || (k % 10) AS item, CAST(floor(value * 1000) AS BIGINT) AS during_time,
             'course_id' AS item_type,
             CASE WHEN event_type NOT IN ('view', 'signup') THEN 'home' END AS last_page_id
      FROM ev""",
    "pages": "SELECT * FROM common WHERE event_type <> 'error'",
    "videos": """
      SELECT *, CAST(floor(value) AS INTEGER) AS play_sec, CAST(k AS VARCHAR) AS video_id, k AS position_sec
      FROM common WHERE event_type = 'click'""",
    "searches": "SELECT text AS item, 1704067200000 + doc_id * 1000 AS ts FROM documents",
    # Log records: which parts each one has.
    "logs": """
      SELECT *, on_page AND event_type = 'view' AND k % 4 > 0 AS has_displays,
             on_page AND event_type = 'purchase' AS has_actions
      FROM (SELECT *, NOT is_start AND NOT is_video AS on_page
            FROM (SELECT *, k % 7 = 0 AS is_start, event_type = 'error' AS has_err,
                         k % 7 <> 0 AND event_type = 'click' AND k % 3 = 0 AS is_video
                  FROM common))
      WHERE k < 97""",
    "order_info": """
      SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
             'T' || o_orderkey AS out_trade_no, o_orderpriority AS trade_body,
             (o_custkey // 10) || '-' || strftime(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER), '%Y-%m-%d')
               AS session_id,
             CAST(c_nationkey AS VARCHAR) AS province_id,
             epoch_us(o_orderdate) // 1000000 + o_orderkey % 86400 AS ts
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "order_detail": f"""
      SELECT *, strftime(make_timestamp(ts * 1000000), {STAMP}) AS create_time,
             strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS create_date
      FROM (SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_suppkey AS VARCHAR) AS course_id,
                   'Course ' || l_suppkey AS course_name, CAST(l_orderkey AS VARCHAR) AS order_id,
                   CAST(l_orderkey % 997 AS VARCHAR) AS user_id,
                   CAST(l_extendedprice AS DECIMAL(18,2)) AS origin_amount,
                   CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))
                     AS coupon_reduce,
                   CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))
                     AS final_amount,
                   epoch_us(l_shipdate) // 1000000 + (l_orderkey * 37 + l_linenumber) % 86400 AS ts
            FROM lineitem)""",
    "payments": f"""
      SELECT *, strftime(make_timestamp(ts * 1000000), {STAMP}) AS create_time,
             strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS create_date,
             strftime(make_timestamp(ts * 1000000), {STAMP}) AS callback_time
      FROM (SELECT 'P' || o_orderkey AS id, 'T' || o_orderkey AS out_trade_no, CAST(o_orderkey AS VARCHAR) AS order_id,
                   'A' || o_orderkey AS alipay_trade_no, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
                   o_orderpriority AS trade_body, '110' || (o_orderkey % 2) AS payment_type, '1602' AS payment_status,
                   epoch_us(o_orderdate) // 1000000 + o_orderkey % 86400 AS ts
            FROM orders WHERE o_orderstatus = 'F')""",
    "order_log": "SELECT sid AS session_id, sc AS source_id, ts FROM pages WHERE page_id = 'order'",
    "last_log": """
      SELECT session_id, source_id FROM order_log
      QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, source_id DESC) = 1""",
    "last_detail": """
      SELECT * FROM order_detail
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, md5(concat_ws('|', course_id, course_name, order_id,
        user_id, origin_amount, coupon_reduce, final_amount)) DESC) = 1""",
    "orders_fact": """
      SELECT d.*, i.out_trade_no, i.trade_body, i.session_id, i.province_id, l.source_id
      FROM last_detail d JOIN order_info i ON d.order_id = i.id LEFT JOIN last_log l ON i.session_id = l.session_id""",
    "payments_fact": """
      SELECT p.id, p.out_trade_no, p.order_id, p.alipay_trade_no, p.total_amount, p.trade_body, p.payment_type,
             p.payment_status, p.create_time, p.create_date, p.callback_time, d.course_id, d.course_name, d.user_id,
             d.origin_amount, d.coupon_reduce, d.final_amount, d.session_id, d.province_id, d.source_id, p.ts
      FROM payments p LEFT JOIN (
        SELECT * FROM orders_fact
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, id DESC) = 1) d ON p.order_id = d.order_id""",
    "registers": f"""
      SELECT CAST(user_id AS VARCHAR) AS id, strftime(make_timestamp(min(ts_s) * 1000000), {STAMP}) AS create_time,
             strftime(make_timestamp(min(ts_s) * 1000000), '%Y-%m-%d') AS create_date, min(ts_s) AS ts
      FROM ev WHERE event_type = 'signup' GROUP BY user_id""",
    "event_changes": """
      SELECT CASE WHEN k % 10 = 9 THEN 'other' ELSE 'edu' END AS "database",
             CASE event_type WHEN 'click' THEN 'cart_info' WHEN 'view' THEN 'review_info' WHEN 'signup' THEN 'favor_info'
                  WHEN 'purchase' THEN 'test_exam' ELSE 'comment_info' END AS "table",
             CASE event_type WHEN 'click' THEN 'insert' WHEN 'view' THEN 'update' WHEN 'signup' THEN 'bootstrap-insert'
                  WHEN 'purchase' THEN 'insert' ELSE 'other' END AS type,
             ts_s AS ts, CAST(event_id AS VARCHAR) AS id,
             CASE WHEN k % 8 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
             CASE WHEN k % 8 <> 0 THEN CAST(k AS VARCHAR) END AS course_id,
             CASE WHEN k % 8 <> 0 THEN 'x' || k END AS extra, k
      FROM ev""",
    "config_rows": """
      SELECT 't' || user_id AS source_table, 'dim_' || k AS sink_table, 'id,c' || k AS sink_columns,
             CASE event_type WHEN 'error' THEN 'd' WHEN 'view' THEN 'u' WHEN 'signup' THEN 'c' ELSE 'r' END AS op,
             ts AS ts_ms, event_id
      FROM ev""",
    "user_changes": """
      SELECT CAST(user_id AS VARCHAR) AS id,
             CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS type, ts, event_id,
             CASE WHEN event_type IN ('click', 'signup') THEN 'level' || (k % 10) END AS level,
             CASE WHEN event_type IN ('view', 'signup') THEN CAST(k AS VARCHAR) END AS score
      FROM ev""",
    "dim_province": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation",
    "dim_source": "SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS source_site FROM region",
    "dim_course": """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS course_name,
                            CAST(s_nationkey AS VARCHAR) AS subject_id FROM supplier""",
    "dim_subject": """SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS subject_name,
                             CAST(n_regionkey AS VARCHAR) AS category_id FROM nation""",
    "dim_category": "SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS category_name FROM region",
    "dim_video": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS chapter_id FROM part",
    "dim_chapter": "SELECT DISTINCT p_brand AS id, 'Chapter ' || p_brand AS chapter_name FROM part",
    "dim_paper": """SELECT CAST(s_suppkey AS VARCHAR) AS id, 'Paper ' || s_name AS paper_title,
                           CAST(s_nationkey AS VARCHAR) AS course_id FROM supplier""",
    "dim_question": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS question_txt FROM part",
}

# Which expressions each one reads.
NEEDS = {
    "common": ["ev"], "pages": ["common"], "videos": ["common"], "logs": ["common"], "order_log": ["pages"],
    "last_log": ["order_log"], "last_detail": ["order_detail"],
    "orders_fact": ["last_detail", "order_info", "last_log"], "payments_fact": ["payments", "orders_fact"],
    "registers": ["ev"], "event_changes": ["ev"], "config_rows": ["ev"], "user_changes": ["ev"],
}


def with_inputs(names: str, body: str, **extra: str) -> str:
    """A query over the named inputs; `extra` adds further expressions after them, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}"


def stamp(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), {STAMP})"


def day(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d')"


def day_no(ms: str) -> str:
    return f"(({ms}) // 86400000)"


def window_start(ms: str, size_ms: int) -> str:
    return f"(({ms}) // {size_ms} * {size_ms})"


def bounds(size_ms: int, cur_date: bool = True, start: str = "w") -> str:
    """Select list of the window texts over a column with the window start."""
    out = f"{stamp(start)} AS stt, {stamp(f'{start} + {size_ms}')} AS edt"
    return out + (f", {day(start)} AS cur_date" if cur_date else "")
