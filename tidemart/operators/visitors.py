"""New, unique, bouncing, logging-in and returning visitors, over page logs.

`tie` names columns that order rows with equal ts. Per-key work is either an aggregation with a
partial step or a window whose groups are bounded in time, never the whole history of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed
from ..functions import timefmt
from . import filters, firsts


def fix_is_new(logs: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Correct is_new per device: '1' on a later day than the first visit becomes '0'.

    A device whose first record says '0' was known before, so each later '1' becomes '0' too.
    Only records that say '1' meet the per-device table; the others pass without a shuffle.
    """
    says_new = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    day = timefmt.day_of_millis("ts")

    seen = logs.select(F.col("common.mid").alias("_mid"), "ts", *tie, day.alias("_day"), F.col("common.is_new").alias("_is_new"))
    first = firsts.join_side(seen, "_mid", ["ts", *tie, "_day", "_is_new"], F.min)
    known = first.select(
        "_mid", F.when(F.col("_is_new") == "1", F.col("_day")).otherwise(F.date_sub("_day", 1)).alias("_visit_day"))

    claims = logs.where(says_new)
    fixed_flag = F.when(F.col("_visit_day") != day, "0").otherwise(F.col("common.is_new"))
    corrected = claims.join(known, claims["common.mid"] == known["_mid"], "left").withColumn(
        "common", F.col("common").withField("is_new", fixed_flag)).select(*logs.columns)
    return logs.where(~says_new).unionByName(corrected)


def unique_visitor_daily(pages: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """The first entry page per device and day."""
    entries = filters.entry_pages(pages).withColumn("_mid", F.col("common.mid"))
    return firsts.daily_first(entries, ["_mid"], ["ts", *tie]).drop("_mid")


def user_jump(pages: DataFrame, tie: Sequence[str] = (), timeout_ms: int = fixed.JUMP_TIMEOUT_MS,
              timeouts_per_slice: int = 4) -> DataFrame:
    """Entry pages whose visitor left: the device's next page is again an entry, or none follows in time.

    The next page only matters within the timeout, so a device's time line is cut into slices of a few
    timeouts. A page in the first timeout of its slice is also shown, as a thin row, to the slice before.
    The window then sorts one slice of one device at a time, whatever the length of the device's history.
    """
    slice_ms = timeouts_per_slice * timeout_ms
    entry = F.col("page.last_page_id").isNull()
    payload = [c for c in pages.columns if c != "ts" and c not in tie]
    own = F.floor(F.col("ts") / slice_ms)
    early = F.col("ts") - own * slice_ms < timeout_ms
    sliced = pages.select(
        "ts", *tie, F.col("common.mid").alias("_mid"), entry.alias("_entry"),
        # Pages that are no entries only end the wait of others: their content stays behind.
        F.when(entry, F.struct(*payload)).alias("_row"), own.alias("_own"),
        F.explode(F.when(early, F.array(own, own - 1)).otherwise(F.array(own))).alias("_slice"),
    ).withColumn("_row", F.when(F.col("_slice") == F.col("_own"), F.col("_row")))

    order = Window.partitionBy("_mid", "_slice").orderBy("ts", *tie)
    next_ts, next_entry = F.lead("ts").over(order), F.lead("_entry").over(order)
    judged = sliced.withColumn(
        "_jump", next_ts.isNull() | next_entry | (next_ts - F.col("ts") >= timeout_ms))
    kept = judged.where(F.col("_row").isNotNull() & F.col("_jump"))
    return kept.select("ts", *tie, "_row.*").select(*pages.columns)


def first_login(pages: DataFrame, tie: Sequence[str] = (), key: str = "common.mid") -> DataFrame:
    """The earliest logged-in page per device (or other log field) and day, as flat login rows."""
    logged_in = filters.filter_login_pages(pages).select("common", "ts", *tie, F.col(key).alias("_key"))
    return filters.flatten_login(firsts.daily_first(logged_in, ["_key"], ["ts", *tie]))


def login_uv_back(logins: DataFrame, user: str = "user_id") -> DataFrame:
    """Per user and day of login: uv 1, and back 1 if the login before was more than 7 days ago.

    The distance runs from the midnight of the previous login day. The window holds one row per day
    of a user.
    """
    daily = firsts.daily_first_time(logins, [user])
    before = F.lag(firsts.DAY).over(Window.partitionBy(user).orderBy(firsts.DAY))
    away = F.col("ts") - F.unix_millis(before.cast("timestamp"))
    return daily.select(
        user, "ts", F.lit(1).alias("uv_count"),
        F.when(away > fixed.RETURN_AFTER_MS, 1).otherwise(0).alias("back_count"))


def user_daily_new(facts: DataFrame, user: str = "user_id", unit: str = "s") -> DataFrame:
    """Per user and day with a fact: uv 1, and new 1 on the user's first day of all."""
    daily = firsts.daily_first_time(facts, [user], unit=unit)
    first_day = F.min(firsts.DAY).over(Window.partitionBy(user))
    return daily.select(
        user, "ts", F.lit(1).alias("uv_count"),
        F.when(F.col(firsts.DAY) == first_day, 1).otherwise(0).alias("new_count"))
