"""Starting streams and putting their results into tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import MetricTable


def to_files(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to files, each row exactly once, until its present input is used up."""
    return (rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def to_table(rows: DataFrame, table: MetricTable, checkpoint: str, mode: str = "append",
             prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
    """Write each micro-batch under its id, so that a repeated one replaces itself.

    `prepare` acts on a micro-batch as on any table: routing, dimension lookups, JSON.
    """
    return (rows.writeStream.foreachBatch(lambda batch, batch_id: table.write(prepare(batch), batch_id))
            .outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
