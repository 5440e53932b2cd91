"""Topics and tables as DataFrames, batch or streaming, by format and options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_topic(spark: SparkSession, fmt: str, streaming: bool = False, path: str | None = None, **options) -> DataFrame:
    """A topic of text records as one column `value`: Kafka, text files, or any source with such a column."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if fmt != "kafka" and fmt != "text":
        reader = reader.schema("value string")
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


def read_table(spark: SparkSession, path: str, schema: str | None = None, streaming: bool = False,
               fmt: str = "parquet", **options) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def drop_tombstones(df: DataFrame) -> DataFrame:
    """Leave out empty records: a null value is the delete marker of a keyed topic."""
    return df.where(F.col("value").isNotNull() & (F.col("value") != ""))
