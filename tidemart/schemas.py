"""Input record schemas, as Spark DDL."""

CDC_ENVELOPE = (
    "database string, `table` string, type string, ts bigint, xid bigint, commit boolean, "
    "data map<string,string>, old map<string,string>"
)

COMMON = (
    "sc:string, ar:string, uid:string, os:string, ch:string, is_new:string, md:string, "
    "mid:string, vc:string, ba:string, sid:string"
)
PAGE = "page_id:string, item:string, during_time:bigint, item_type:string, last_page_id:string"
DISPLAY = "display_type:string, item:string, item_type:string, pos_id:int, `order`:int"
VIDEO = "play_sec:int, video_id:string, position_sec:int"

# start and err stay raw JSON text: their inner fields are not fixed.
LOG = (
    f"common struct<{COMMON}>, page struct<{PAGE}>, displays array<struct<{DISPLAY}>>, "
    f"actions array<map<string,string>>, start string, err string, appVideo struct<{VIDEO}>, ts bigint"
)

PAGE_LOG = f"common struct<{COMMON}>, page struct<{PAGE}>, ts bigint"
PAGE_LOG_MAPS = "common map<string,string>, page map<string,string>, ts bigint"

DIM_CONFIG = "source_table:string, sink_table:string, sink_columns:string, sink_family:string, sink_row_key:string"
FACT_CONFIG = "source_table:string, source_type:string, sink_table:string, sink_columns:string"


def config_change(row: str) -> str:
    """Schema of a config change record around a config row."""
    return f"before struct<{row}>, after struct<{row}>, op string, ts_ms bigint"


# Fact topics: JSON objects. Values may come as text or number, so each is read as text and then cast.
ORDER_DETAIL = (
    "id string, course_id string, course_name string, order_id string, user_id string, origin_amount string, "
    "coupon_reduce string, final_amount string, create_time string, create_date string, out_trade_no string, "
    "trade_body string, session_id string, province_id string, source_id string, ts bigint"
)
PAYMENT_DETAIL = (
    "id string, out_trade_no string, order_id string, alipay_trade_no string, total_amount string, trade_body string, "
    "payment_type string, payment_status string, create_time string, create_date string, callback_time string, "
    "course_id string, course_name string, user_id string, origin_amount string, coupon_reduce string, "
    "final_amount string, session_id string, province_id string, source_id string, ts bigint"
)
LOGIN = (
    "user_id string, source_id string, channel string, province_id string, version_code string, mid_id string, "
    "brand string, model string, operating_system string, login_time string, date_id string, ts bigint"
)
REGISTER = "user_id string, register_time string, register_date string, ts bigint"
CART_ADD = "id string, user_id string, course_id string, ts bigint"
REVIEW = "id string, user_id string, course_id string, review_stars bigint, ts bigint"
EXAM_PAPER = "id string, paper_id string, user_id string, score double, duration_sec bigint, ts bigint"
EXAM_QUESTION = "id string, paper_id string, question_id string, user_id string, is_correct string, ts bigint"
