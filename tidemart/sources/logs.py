"""Behaviour log records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed, schemas
from ..functions import jsontext
from .cdc import parse_tolerant
from .readers import drop_tombstones


def parse_log(topic: DataFrame) -> DataFrame:
    """Log lines with struct column rec; see split_dirty for the two outputs."""
    return jsontext.parse(drop_tombstones(topic), schemas.LOG)


def split_dirty(topic: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed records, dirty lines): dirty is what is no JSON object, and nothing else. Each output parses by itself."""
    parsed = parse_log(topic)
    good = parsed.where(~jsontext.is_bad()).select(
        *[c for c in parsed.columns if c not in ("value", "rec")], "rec.*").drop(jsontext.BAD)
    return good, parsed.where(jsontext.is_bad()).select("value")


def read_page_log(topic: DataFrame, maps: bool = False) -> DataFrame:
    """Page records with common and page as structs (pruned field by field) or as maps."""
    return parse_tolerant(topic, schemas.PAGE_LOG_MAPS if maps else schemas.PAGE_LOG)


def extract_order_log(pages: DataFrame) -> DataFrame:
    """Session to source, from order pages. ts is kept to pick the latest row of a session."""
    return pages.where(F.col("page.page_id") == fixed.PAGE_ORDER).select(
        F.col("common.sid").alias("session_id"), F.col("common.sc").alias("source_id"), "ts")


# Output column of the register join and the log field it comes from.
REGISTER_FIELDS = {
    "user_id": "uid", "channel": "ch", "province_id": "ar", "version_code": "vc", "source_id": "sc",
    "mid_id": "mid", "brand": "ba", "model": "md", "operate_system": "os",
}


def extract_dim_log(pages: DataFrame) -> DataFrame:
    """Device and channel attributes of logged-in users. ts is kept to pick the latest row of a user."""
    return pages.where(F.col("common.uid").isNotNull()).select(
        *[F.col(f"common.{field}").alias(name) for name, field in REGISTER_FIELDS.items()], "ts")


# Output column of a play row and the log field it comes from.
PLAY_FIELDS = {
    "source_id": "sc", "province_id": "ar", "user_id": "uid", "operating_system": "os", "channel": "ch",
    "is_new": "is_new", "model": "md", "machine_id": "mid", "version_code": "vc", "brand": "ba",
    "session_id": "sid",
}


def flatten_play(videos: DataFrame) -> DataFrame:
    """Fifteen flat columns of a play record."""
    return videos.select(
        *[F.col(f"common.{field}").alias(name) for name, field in PLAY_FIELDS.items()],
        F.col("appVideo.play_sec").alias("play_sec"), F.col("appVideo.position_sec").alias("position_sec"),
        F.col("appVideo.video_id").alias("video_id"), "ts")
