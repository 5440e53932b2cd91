"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]

#: Up to 200 parts a map task writes without sorting them in memory.
BATCH_PARTS = 192

#: What a map task reads of a file: a partial aggregate of wide rows sorts its share of them in memory.
SPLIT = "32m"

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its key, with the SQL that gives the same result."""

    def put(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark).conf.set("spark.sql.session.timeZone", "UTC")  # the zone in which the SQL counts days
            if spark.conf.get("spark.sql.shuffle.partitions") == "200":
                # The default, so nobody chose it. Streams open a state store per partition: one per core is enough.
                spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
            if spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None:
                # Batches start from more parts and merge the small ones again, so that a task's share of a large table stays small.
                spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(BATCH_PARTS))
            if spark.conf.get("spark.sql.files.maxPartitionBytes") in ("134217728b", "134217728", "128MB"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT)
            return run(spark, sf_dir)

        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = tuned
        if sql is not None:
            SQL[key] = sql
        return run

    return put
