"""Change records of the business database."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed, schemas
from ..functions import jsontext


def read_cdc_envelope(topic: DataFrame, watermark: str | None = fixed.DELAY_LONG, tables: Sequence[str] = ()) -> DataFrame:
    """Change records with data and old as maps, event time from the epoch seconds in ts.

    Records that do not parse are skipped. The watermark only acts on streams. `tables` names those that are wanted: only their
    records come out, and a line that has none of the names in it and no escape, so cannot be one of them, is not parsed.
    """
    if tables:
        value = F.col("value")
        named = functools.reduce(lambda a, b: a | b, [value.contains(t) for t in tables])
        topic = topic.where(named | value.contains("\\"))
    rows = parse_tolerant(topic, schemas.CDC_ENVELOPE)
    rows = rows.where(F.col("table").isin(*tables)) if tables else rows
    rows = rows.withColumn("event_time", F.timestamp_seconds("ts"))
    return rows.withWatermark("event_time", watermark) if watermark and rows.isStreaming else rows


def parse_tolerant(topic: DataFrame, schema: str) -> DataFrame:
    """Parse JSON records and skip those that are empty or broken."""
    parsed = jsontext.parse(topic, schema)
    good = parsed.where(F.col("rec").isNotNull() & ~jsontext.is_bad())
    return good.select("rec.*").drop(jsontext.BAD)


def _clean(changes: DataFrame, database: str, types: Sequence[str]) -> DataFrame:
    return changes.where(
        (F.col("database") == database) & F.col("type").isin(*types) & (F.size("data") >= 2)
    )


def cdc_clean_dim(changes: DataFrame, database: str = fixed.DATABASE) -> DataFrame:
    """Changes of one database, of the four row types, that carry at least two fields."""
    return _clean(changes, database, fixed.ROW_TYPES)


def cdc_clean_fact(changes: DataFrame, database: str = fixed.DATABASE,
                   types: Sequence[str] = (fixed.INSERT,)) -> DataFrame:
    """As cdc_clean_dim, inserts only."""
    return _clean(changes, database, types)


def rows_of(changes: DataFrame, table: str, types: Sequence[str] = (fixed.INSERT,),
            database: str | None = fixed.DATABASE) -> DataFrame:
    """Changes of one table."""
    rows = changes.where((F.col("table") == table) & F.col("type").isin(*types))
    return rows if database is None else rows.where(F.col("database") == database)


def fields(*names: str) -> list:
    """Entries of the data map as text columns."""
    return [F.col("data")[n].alias(n) for n in names]


def _day(field: str):
    # The text is 'yyyy-MM-dd HH:mm:ss'; a text that is no date gives null.
    return F.date_format(F.try_to_timestamp(F.col("data")[field]), "yyyy-MM-dd")


ORDER_DETAIL = ("id", "course_id", "course_name", "order_id", "user_id", "origin_amount", "coupon_reduce",
                "final_amount", "create_time")
ORDER_INFO = ("id", "user_id", "out_trade_no", "trade_body", "session_id", "province_id")
PAYMENT = ("id", "out_trade_no", "order_id", "alipay_trade_no", "total_amount", "trade_body", "payment_type",
           "payment_status", "create_time", "callback_time")


def extract_order_detail(changes: DataFrame, types: Sequence[str] = (fixed.INSERT,)) -> DataFrame:
    return rows_of(changes, "order_detail", types).select(
        *fields(*ORDER_DETAIL), _day("create_time").alias("create_date"), "ts")


def extract_order_info(changes: DataFrame, types: Sequence[str] = (fixed.INSERT,)) -> DataFrame:
    return rows_of(changes, "order_info", types).select(*fields(*ORDER_INFO), "ts")


def extract_payment(changes: DataFrame, types: Sequence[str] = (fixed.INSERT,)) -> DataFrame:
    """Payments. A live shop confirms them by update: pass types=('update',) there."""
    return rows_of(changes, "payment_info", types).select(
        *fields(*PAYMENT), _day("create_time").alias("create_date"), "ts")


def extract_user_register(changes: DataFrame) -> DataFrame:
    return rows_of(changes, "user_info", database=None).select(
        *fields("id", "create_time"), _day("create_time").alias("create_date"), "ts")
