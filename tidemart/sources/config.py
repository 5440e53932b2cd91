"""Routing configuration from a snapshot and a change stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed

DIM_KEY = ("source_table",)
FACT_KEY = ("source_table", "source_type")


def cdc_before_after(changes: DataFrame) -> DataFrame:
    """The config row a change is about (before it for a delete, else after it) with its op."""
    row = F.when(F.col("op") == fixed.CONFIG_DELETE, F.col("before")).otherwise(F.col("after"))
    rest = [c for c in changes.columns if c not in ("before", "after", "op")]
    return changes.withColumn("row", row).select("row.*", "op", *rest)


def config_latest(rows: DataFrame, key: Sequence[str] = DIM_KEY, order: Sequence[str] = ("ts_ms",)) -> DataFrame:
    """Current config: the last row per key, unless that row is a delete.

    Snapshot rows (op r) and changes go in together. max over a struct keeps one row per key and
    map task before the shuffle.
    """
    rest = [c for c in rows.columns if c not in (*key, *order)]
    last = rows.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("last"))
    return last.select(*key, "last.*").where(F.col("op") != fixed.CONFIG_DELETE)
