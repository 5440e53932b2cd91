"""Change records to the tables their configuration names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def route_dims(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Join changes to the dimension config by table; tables without config drop out.

    The config holds one row per source table; Spark broadcasts it while its measured size is
    under the broadcast threshold and shuffles otherwise.
    """
    return changes.join(config.withColumnRenamed("source_table", "table"), ["table"])


def route_facts(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Join changes to the fact config by table and row type."""
    keyed = config.withColumnsRenamed({"source_table": "table", "source_type": "type"})
    return changes.join(keyed, ["table", "type"])


def prune_sink_columns(routed: DataFrame) -> DataFrame:
    """Keep only the data entries that the config lists."""
    wanted = F.split("sink_columns", ",")
    return routed.withColumn("data", F.map_filter("data", lambda k, v: F.array_contains(wanted, k)))


def attach_meta(routed: DataFrame, field: str) -> DataFrame:
    """Put the row type ('type', dimensions) or the change time ('ts', facts) into the data map."""
    # An entry of that name in the data gives way to the record's own.
    others = F.map_filter("data", lambda k, v: k != F.lit(field))
    meta = F.create_map(F.lit(field), F.col(field).cast("string"))
    return routed.withColumn("data", F.map_concat(others, meta))


def route_by_config(changes: DataFrame, config: DataFrame, kind: str) -> DataFrame:
    """Routed, pruned and labelled changes; kind is 'dim' or 'fact'."""
    if kind == "dim":
        return attach_meta(prune_sink_columns(route_dims(changes, config)), "type")
    return attach_meta(prune_sink_columns(route_facts(changes, config)), "ts")
