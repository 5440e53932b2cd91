"""JSON topics: plain, and routed by a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import jsontext, names


def to_json_rows(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """One JSON text per row, without the columns in `drop`."""
    return df.select(jsontext.record([c for c in df.columns if c not in drop]).alias("value"))


def to_snake_json(df: DataFrame, transient: tuple[str, ...] = ()) -> DataFrame:
    """As to_json_rows, with snake_case names; `transient` names columns that are not written."""
    return to_json_rows(names.snake_columns(df.drop(*transient)))


def routed_rows(routed: DataFrame) -> DataFrame:
    """(sink_table, value) of routed change records: the data map as JSON."""
    return routed.select("sink_table", F.to_json("data").alias("value"))


def append(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Append (value) rows as text, one folder per value of column `by`.

    Rows of one sink are spread over as many files as there are tasks: a large sink is not gathered.
    """
    writer = rows.write.mode("append").format("text")
    (writer.partitionBy(by) if by else writer).save(path)


def append_stream(rows: DataFrame, path: str, checkpoint: str, by: str | None = None, fmt: str = "text",
                  **options: str) -> StreamingQuery:
    """The same for a stream. For a Kafka sink pass fmt='kafka'; a `topic` column then routes the rows."""
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = (writer.partitionBy(by) if by else writer).options(**options).trigger(availableNow=True)
    return writer.start(path) if path else writer.start()
