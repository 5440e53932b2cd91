"""Names and codes that the input records and output tables use."""

# Source database, row types of a change record, operations of a config change.
DATABASE = "edu"
ROW_TYPES = ("insert", "update", "delete", "bootstrap-insert")
INSERT = "insert"
DELETE = "delete"
CONFIG_DELETE = "d"
CONFIG_UPDATE = "u"

# Log streams.
LOG_DIRTY = "dwd_traffic_dirty"
LOG_START = "dwd_traffic_start"
LOG_ERR = "dwd_traffic_err"
LOG_PAGE = "dwd_traffic_page"
LOG_ACTION = "dwd_traffic_action"
LOG_DISPLAY = "dwd_traffic_display"
LOG_VIDEO = "dwd_traffic_appvideo"

# Input topics, fact topics and metric tables.
TOPIC_DB = "topic_db"
TOPIC_LOG = "topic_log"
FACT_UNIQUE_VISITOR = "dwd_traffic_uni_visitor_detail"
FACT_USER_JUMP = "dwd_traffic_user_jump"
FACT_STUDY_PLAY = "dwd_study_play"
FACT_LOGIN = "dwd_user_login"
FACT_REGISTER = "dwd_user_register"
FACT_ORDER_DETAIL = "dwd_trade_order_detail"
FACT_PAYMENT = "dwd_trade_pay_sus_detail"
FACT_CART_ADD = "dwd_trade_cart_add"
FACT_EXAM_PAPER = "dwd_exam_test_paper"
FACT_EXAM_QUESTION = "dwd_exam_test_exam_question"
FACT_REVIEW = "dwd_interaction_review"
METRIC_KEYWORD = "dws_traffic_source_keyword_page_view_window"
METRIC_TRAFFIC = "dws_traffic_vc_source_ar_is_new_page_view_window"
METRIC_PAGE_VIEW = "dws_traffic_page_view_window"
METRIC_CHAPTER_PLAY = "dws_study_chapter_play_window"
METRIC_LOGIN = "dws_user_user_login_window"
METRIC_REGISTER = "dws_user_user_register_window"
METRIC_CART_ADD = "dws_trade_cart_add_window"
METRIC_ORDER_USERS = "dws_trade_order_detail_window"
METRIC_PAY_USERS = "dws_trade_pay_suc_window"
METRIC_COURSE_ORDERS = "dws_trade_course_order_window"
METRIC_SOURCE_ORDERS = "dws_trade_source_order_window"
METRIC_PROVINCE_ORDERS = "dws_trade_order_provinces_window"
METRIC_REVIEW = "dws_interaction_course_review_window"
METRIC_EXAM_PAPER = "dws_exam_paper_test_window"
METRIC_EXAM_SCORE = "dws_exam_score_test_window"
METRIC_EXAM_QUESTION = "dws_exam_questions_test_window"

# The three pages of the page-view metric and the order page.
PAGE_HOME = "home"
PAGE_LIST = "course_list"
PAGE_DETAIL = "course_detail"
PAGE_ORDER = "order"
KEYWORD_ITEM = "keyword"
KEYWORD_SOURCE = "SEARCH"

# Window lengths, gaps and delays.
METRIC_WINDOW = "10 seconds"
PROVINCE_WINDOW = "5 seconds"
SESSION_GAP = "3 seconds"
JUMP_TIMEOUT_MS = 10_000
LOGIN_HOLD_MS = 2_000
RETURN_AFTER_MS = 7 * 24 * 3600 * 1000
DELAY_LONG = "5 seconds"
DELAY_SHORT = "3 seconds"
DELAY_NONE = "0 seconds"
STATE_TTL_MS = 24 * 3600 * 1000
ORDER_JOIN_BOUND = "15 seconds"
REGISTER_JOIN_BOUND = "10 seconds"
# How long a correcting join remembers a row after its last write.
ORDER_IDLE_MS = 15_000
REGISTER_IDLE_MS = 10_000
