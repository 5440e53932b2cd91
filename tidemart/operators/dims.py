"""Dimension tables: lookups and upserts.

Lookups are plain left joins after the aggregation. Spark broadcasts a dimension while its measured
size is under spark.sql.autoBroadcastJoinThreshold and shuffles it beyond; no size is assumed here.
A key without a dimension row keeps its fact, with null names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed


def dim_lookup(facts: DataFrame, dim: DataFrame, key: str, columns: Mapping[str, str], dim_key: str = "id") -> DataFrame:
    """Add dimension columns by key; `columns` maps dimension column to output column."""
    side = dim.select(F.col(dim_key).alias(key), *[F.col(c).alias(name) for c, name in columns.items()])
    return facts.join(side, [key], "left").select(*facts.columns, *columns.values())


def dim_snowflake_3(facts: DataFrame, course: DataFrame, subject: DataFrame, category: DataFrame) -> DataFrame:
    """Course to subject to category, each key from the lookup before."""
    out = dim_lookup(facts, course, "course_id", {"course_name": "course_name", "subject_id": "subject_id"})
    out = dim_lookup(out, subject, "subject_id", {"subject_name": "subject_name", "category_id": "category_id"})
    return dim_lookup(out, category, "category_id", {"category_name": "category_name"})


def dim_chain_2(facts: DataFrame, video: DataFrame, chapter: DataFrame) -> DataFrame:
    """Video to chapter id to chapter name."""
    out = dim_lookup(facts, video, "video_id", {"chapter_id": "chapter_id"})
    return dim_lookup(out, chapter, "chapter_id", {"chapter_name": "chapter_name"})


def dim_two_keys(facts: DataFrame, source: DataFrame, province: DataFrame) -> DataFrame:
    """Source name and province name."""
    out = dim_lookup(facts, source, "source_id", {"source_site": "source_name"})
    return dim_lookup(out, province, "province_id", {"name": "province_name"})


def dic_lookup(facts: DataFrame, dictionary: DataFrame, code: str, out: str = "dic_name") -> DataFrame:
    """Dictionary name by code; the dictionary keeps it in struct column info."""
    side = dictionary.select(F.col("dic_code").alias(code), F.col("info.dic_name").alias(out))
    return facts.join(side, [code], "left").select(*facts.columns, out)


def dim_upsert(changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """State of a dimension after its changes: a put overwrites the columns it carries (null ones do
    not count), a delete removes the row.

    One aggregation: per column the last put that carries it, which counts if it came after the last
    delete. `changes` has type and the data map; `order` orders the changes of a row totally.
    """
    rows = changes.select(F.col("data")[key].alias(key), "type", F.struct(*order).alias("at"),
                          *[F.col("data")[c].alias(c) for c in columns if c != key])
    return _merge(rows, key, [c for c in columns if c != key])


def merge_dim(current: DataFrame, changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A stored dimension after further changes: its rows count as puts before all of them."""
    others = [c for c in columns if c != key]
    rows = changes.select(F.col("data")[key].alias(key), "type",
                          F.struct(F.lit(1).alias("batch"), *order).alias("at"),
                          *[F.col("data")[c].alias(c) for c in others])
    before = F.struct(F.lit(0).alias("batch"), *[F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in order])
    stored = current.select(key, F.lit(fixed.INSERT).alias("type"), before.alias("at"), *others)
    return _merge(stored.unionByName(rows), key, others)


def _merge(rows: DataFrame, key: str, others: Sequence[str]) -> DataFrame:
    put = F.col("type") != fixed.DELETE
    state = rows.groupBy(key).agg(
        F.max(F.when(~put, F.col("at"))).alias("_deleted"),
        F.max(F.when(put, F.col("at"))).alias("_put"),
        *[F.max(F.when(put & F.col(c).isNotNull(), F.struct("at", c))).alias(c) for c in others])

    def alive(at):
        return F.col("_deleted").isNull() | (at > F.col("_deleted"))

    return state.where(F.col("_put").isNotNull() & alive(F.col("_put"))).select(
        key, *[F.when(alive(F.col(c)["at"]), F.col(c)[c]).alias(c) for c in others])
