"""Row filters and flat projections over page logs and order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from ..functions import timefmt


def entry_pages(pages: DataFrame) -> DataFrame:
    """Pages that were not reached from another page."""
    return pages.where(F.col("page.last_page_id").isNull())


def filter_login_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("common.uid").isNotNull())


def filter_three_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page.page_id").isin(fixed.PAGE_HOME, fixed.PAGE_LIST, fixed.PAGE_DETAIL))


def filter_required_keys(facts: DataFrame, *keys: str) -> DataFrame:
    return facts.dropna(subset=list(keys))


# Output column of a login row and the log field it comes from.
LOGIN_FIELDS = {
    "user_id": "uid", "source_id": "sc", "channel": "ch", "province_id": "ar", "version_code": "vc",
    "mid_id": "mid", "brand": "ba", "model": "md", "operating_system": "os",
}


def flatten_login(pages: DataFrame) -> DataFrame:
    """Login rows with login time and day as text."""
    login_time = timefmt.millis_to_datetime("ts")
    return pages.select(
        *[F.col(f"common.{field}").alias(name) for name, field in LOGIN_FIELDS.items()],
        login_time.alias("login_time"), F.substring(login_time, 1, 10).alias("date_id"), "ts")
