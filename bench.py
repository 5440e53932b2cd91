"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Each query runs in full into a sink that discards its rows: once to warm up, then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemart import session  # noqa: E402
from tidemart.plans.all_queries import QUERIES  # noqa: E402

HEADLINE = [
    "split_log", "route_by_config", "fix_is_new", "unique_visitor_daily", "user_jump", "first_login", "session_keyed",
    "dwd_trade_order_detail", "dwd_trade_pay_sus_detail", "join_register_dim", "dim_upsert",
    "dws_keyword", "dws_traffic_vc_source_province_new", "dws_page_view", "dws_chapter_play", "dws_user_login",
    "dws_user_register", "dws_cart_add", "dws_order_users", "dws_pay_users", "dws_course_orders", "dws_source_orders",
    "dws_province_orders", "dws_course_review", "dws_exam_paper", "dws_exam_score", "dws_exam_question",
    "watermark_bounded", "join_payment_detail", "order_daily_flag", "stream_user_jump", "stream_fix_is_new", "stream_cart_add",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session.build(f"local[{os.environ.get('BENCH_CPUS', '8')}]", "bench")
    names = sys.argv[1:] or HEADLINE
    cold, warm = {}, {}
    for name in names:
        cold[name] = seconds(lambda: QUERIES[name](spark, sf_dir))
        warm[name] = seconds(lambda: QUERIES[name](spark, sf_dir))
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": os.environ.get("BENCH_CPUS", "8"),
        "spark": spark.version}))


if __name__ == "__main__":
    main()
