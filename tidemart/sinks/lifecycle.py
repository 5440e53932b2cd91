"""Dimension tables that come and go with their config rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed

CREATE, DROP = "create", "drop"


def lifecycle_steps(config_rows: DataFrame) -> DataFrame:
    """Steps per config change: create for c and r, drop then create for u, drop for d."""
    steps = (F.when(F.col("op") == fixed.CONFIG_DELETE, F.array(F.lit(DROP)))
             .when(F.col("op") == fixed.CONFIG_UPDATE, F.array(F.lit(DROP), F.lit(CREATE)))
             .otherwise(F.array(F.lit(CREATE))))
    return config_rows.select("*", F.posexplode(steps).alias("step", "action"))


def apply_lifecycle(spark: SparkSession, config_rows: DataFrame, order: Sequence[str] = ("ts_ms",),
                    database: str = "default") -> list[str]:
    """Run the changes as DDL, and give back the tables that were dropped.

    Per table the last change decides what is left; a drop or rewrite before it leaves nothing of the old table, so that
    is dropped first. Changes equal in `order` count by op and columns. What reaches the driver is one row per table of
    the catalog.
    """
    change = F.struct(*order, "op", "sink_columns")
    gone = F.col("op").isin(fixed.CONFIG_DELETE, fixed.CONFIG_UPDATE)
    tables = config_rows.where(F.col("sink_table").isNotNull()).groupBy("sink_table").agg(
        F.max(change).alias("last"), F.max(gone).alias("gone"))
    dropped = []
    for row in tables.select("sink_table", "last.op", "last.sink_columns", "gone").orderBy("sink_table").toLocalIterator():
        name = f"`{database}`.`{row.sink_table}`"
        if row.gone:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            dropped.append(row.sink_table)
        if row.op != fixed.CONFIG_DELETE:
            columns = ", ".join(f"`{c}` STRING" for c in row.sink_columns.split(","))
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
    return dropped
