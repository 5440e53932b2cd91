"""Stream-stream joins with bounded state.

Both sides carry a watermark and the condition bounds their distance in event time, so a row leaves the
state once no partner can come any more. A left row without a partner comes out, with nulls, when the
watermark passes its bound, and is not corrected later. Of several partners within the bound the last one counts, as in
the batch joins; the row comes out when the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnRenamed("event_time", f"_{name}_time")


def bounded_join(left: DataFrame, right: DataFrame, key: str, how: str, bound: str) -> DataFrame:
    """Join on `key` with at most `bound` between the event times of the two sides.

    Both sides come with event_time and its watermark; the result has the event_time of the left one.
    """
    a, b = _side(left, "left"), _side(right, "right").withColumnRenamed(key, "_right_key")
    near = F.expr(f"_right_time BETWEEN _left_time - INTERVAL {bound} AND _left_time + INTERVAL {bound}")
    joined = a.join(b, (F.col(key) == F.col("_right_key")) & near, how)
    return joined.drop("_right_key", "_right_time").withColumnRenamed("_left_time", "event_time")


def last_partner(joined: DataFrame, left: Sequence[str], partner: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per left row: the one with the greatest `order`. Left rows that are equal in all columns are one."""
    names = [c for c in left if c != "event_time"]
    last = joined.groupBy("event_time", *names).agg(F.max(F.struct(*order, *[c for c in partner if c not in order])).alias("_last"))
    return last.select("event_time", *names, *[F.col(f"_last.{c}").alias(c) for c in partner])


def join_detail_order(detail: DataFrame, info: DataFrame, bound: str = fixed.ORDER_JOIN_BOUND) -> DataFrame:
    order = info.withColumnRenamed("id", "order_id").drop("user_id", "ts")
    return bounded_join(detail, order, "order_id", "inner", bound)


def join_order_source(orders: DataFrame, order_log: DataFrame, bound: str = fixed.ORDER_JOIN_BOUND) -> DataFrame:
    joined = bounded_join(orders, order_log.withColumnRenamed("ts", "_ts"), "session_id", "leftOuter", bound)
    return last_partner(joined, orders.columns, ["source_id"], ["_ts", "source_id"])


def join_payment_detail(payments: DataFrame, detail: DataFrame, bound: str = fixed.ORDER_JOIN_BOUND) -> DataFrame:
    lines = detail.withColumnsRenamed({"id": "_id", "ts": "_ts"})
    joined = bounded_join(payments, lines, "order_id", "leftOuter", bound)
    partner = [c for c in detail.columns if c not in ("id", "ts", "order_id", "event_time")]
    return last_partner(joined, payments.columns, partner, ["_ts", "_id"])


def join_register_dim(registers: DataFrame, dim_log: DataFrame, bound: str = fixed.REGISTER_JOIN_BOUND) -> DataFrame:
    users = registers.withColumnsRenamed(
        {"id": "user_id", "create_time": "register_time", "create_date": "register_date"})
    joined = bounded_join(users, dim_log.withColumnRenamed("ts", "_ts"), "user_id", "leftOuter", bound)
    partner = [c for c in dim_log.columns if c not in ("ts", "user_id", "event_time")]
    return last_partner(joined, users.columns, partner, ["_ts", *partner])
