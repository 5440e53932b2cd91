"""From raw documents to packed sequences: five stages, each an operator of tidemart.llm.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns a DataFrame; all but
the last return the columns of documents. Between stages the rows are written as Parquet and read again.

language_id      documents without a letter, or whose language cannot be told with the calibrated confidence, go
exact_dedup      of texts equal but for the case of A-Z the row with the largest doc_id stays
near_dedup       of documents linked by SimHash the one with the smallest doc_id stays
mixing           each document is repeated 0, 1 or 2 times, so that sources meet their target words
packing          pieces of tokenized documents in sequences of 4096 ids

Empty tables pass through all stages. Null texts and texts without a letter are rejected by the first stage.
No SQL can express training, balancing or packing, so ORACLE_SQL is None; tests hold run() against plain Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import exact_dedup, langid, mixing, packing, queries, simhash
from tidemart.llm.common import prepared, table, written

PACKING_MEMORY = 30 << 20
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return langid.keep_known(docs, queries.language_model(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return exact_dedup.keep_last(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    # The workers and the executors still hold what the stages before needed: fewer words are remembered here.
    return packing.pack(docs, queries.tokenizer_path(), memory=PACKING_MEMORY)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
