"""Fact joins.

Where several rows would match and the keyed sink keeps the last result anyway, the right side is
reduced to its last row per key before the join. So no group of matches is multiplied out. Hot keys on the left are cut by the adaptive
skew-join rule (see session.tune and firsts.join_side), which splits an oversized partition, even one
of identical rows, and copies the one matching row to each part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .firsts import join_side, latest_per, latest_version

ORDER_COLUMNS = ("out_trade_no", "trade_body", "session_id", "province_id")
PAID_COLUMNS = ("course_id", "course_name", "user_id", "origin_amount", "coupon_reduce", "final_amount",
                "session_id", "province_id", "source_id")

# What makes a record: decides between records of one id and time.
DETAIL_IDENTITY = ("course_id", "course_name", "order_id", "user_id", "origin_amount", "coupon_reduce", "final_amount")
PAYMENT_IDENTITY = ("out_trade_no", "order_id", "alipay_trade_no", "total_amount", "trade_body", "payment_type",
                    "payment_status", "callback_time")


def join_detail_order(detail: DataFrame, info: DataFrame, columns: Sequence[str] = ORDER_COLUMNS) -> DataFrame:
    """Order lines with their order's columns; lines without an order drop out."""
    order = info.select(F.col("id").alias("order_id"), *columns)
    return detail.join(order, ["order_id"]).select(*detail.columns, *columns)


def join_order_source(orders: DataFrame, order_log: DataFrame) -> DataFrame:
    """Order lines with the source of their session's last order page, null without one."""
    last = join_side(order_log, "session_id", ["ts", "source_id"]).drop("ts")
    return orders.join(last, ["session_id"], "left").select(*orders.columns, "source_id")


def order_detail_fact(detail: DataFrame, info: DataFrame, order_log: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """The order detail table: one row per line id, the last one received.

    Of lines of one id and time the one with the greatest digest of DETAIL_IDENTITY stays, whatever columns are asked for.
    `columns` names those that are needed. The last row carries its columns through the shuffle, which no later selection
    can undo, so the rest is left out here, and so is a join that would add nothing.
    """
    kept = [c for c in detail.columns if not columns or c in columns or c == "order_id"]
    lines = latest_version(detail, ["id"], ["ts"], DETAIL_IDENTITY, kept)
    if not columns:
        return join_order_source(join_detail_order(lines.select(*detail.columns), info), order_log)
    wanted = [c for c in ORDER_COLUMNS if c in columns or c == "session_id" and "source_id" in columns]
    facts = join_detail_order(lines, info, wanted)
    return (join_order_source(facts, order_log) if "source_id" in columns else facts).select(*columns)


def join_payment_detail(payments: DataFrame, detail: DataFrame, order_ids: DataFrame | None = None) -> DataFrame:
    """Payments with every line of their order; payments without lines stay.

    The many rows per key are on the right here, where an outer join cannot be cut. So matches come from
    an inner join, which can, and the payments without lines are added. `detail` is used twice.
    """
    lines = detail.select("order_id", *PAID_COLUMNS)
    columns = [*[c for c in payments.columns if c != "ts"], *PAID_COLUMNS, "ts"]
    matched = lines.join(payments, ["order_id"]).select(*columns)
    # `order_ids` may name the orders that have lines by a shorter way than the fact.
    paid_orders = (detail if order_ids is None else order_ids).select(F.col("order_id").alias("_order_id")).distinct()
    unmatched = payments.join(paid_orders, F.col("order_id") == F.col("_order_id"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def payment_fact(payments: DataFrame, detail: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """The payment table: one row per payment id, with the last line of its order. `columns` and ties (by
    PAYMENT_IDENTITY): as in order_detail_fact."""
    paid = [c for c in PAID_COLUMNS if not columns or c in columns]
    kept = [c for c in payments.columns if not columns or c in columns or c == "order_id"]
    last = latest_version(payments, ["id"], ["ts"], PAYMENT_IDENTITY, kept)
    last_line = join_side(detail.select("order_id", "ts", "id", *paid), "order_id", ["ts", "id"])
    joined = last.join(last_line.drop("ts", "id"), ["order_id"], "left")
    return joined.select(*(columns or [*[c for c in payments.columns if c != "ts"], *paid, "ts"]))


def join_register_dim(registers: DataFrame, dim_log: DataFrame, now: bool = True) -> DataFrame:
    """Registrations with the user's last page attributes, one row per user; row_op_ts is the run time."""
    users = latest_per(registers, ["id"], ["ts"])
    attributes = join_side(dim_log, "user_id", ["ts"]).drop("ts")
    joined = users.withColumnsRenamed(
        {"id": "user_id", "create_time": "register_time", "create_date": "register_date"}
    ).join(attributes, ["user_id"], "left")
    names = ["user_id", "register_time", "register_date",
             *[c for c in attributes.columns if c != "user_id"], "ts"]
    out = joined.select(*names)
    return out.withColumn("row_op_ts", F.current_timestamp()) if now else out
