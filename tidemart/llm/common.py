"""What several operators share: words, tables in the shared folder, file names of the given tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, tune

# Fixed value: the white space between words. bytes.split() cuts at the same six characters.
WORD = "[^\\x20\\x09-\\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the operators here: texts are long, so a batch that goes to Python has few rows."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once below the shared folder and read again: cuts the lineage.

    Each task's output is committed once, so later steps see one and the same result even if executors are lost and
    tasks run again.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def learned(column: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo: decides which documents are held out. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus == remainder


def slabs(text: bytes, size: int = 1 << 22):
    """A very long text in pieces that end at white space (the first at or after each 4 MB)."""
    start, n = 0, len(text)
    while n - start > size:
        at = _SPACE.search(text, start + size)
        if at is None:
            break
        yield text[start:at.start()]
        start = at.start()
    yield text[start:] if start else text
