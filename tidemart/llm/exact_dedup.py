"""Exact dedup in two passes over a Bloom filter of text hashes.

Pass one sets one bit per hash; a bit hit twice, in one task or in two, is a possible repeat. Pass two looks every row
up: rows whose bit was hit once are alone and pass straight through, the rest is shuffled by hash and grouped.
A larger filter only saves shuffling; the result does not depend on it.

Null texts count as empty. Texts are equal when they are identical after lower-casing A-Z. The row with the largest
doc_id stays (null ids lose against any other); of rows with equal text and equal doc_id one stays. An empty table
gives an empty result. `mark` returns its own columns only; `keep_last` returns the input's columns, whatever they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

BITS_PER_ROW = 16
MAX_BITS = 1 << 31  # 256 MB: the most that is ever broadcast
SEGMENT = 1 << 16


def text_sha256(text: str | None) -> bytes:
    """SHA-256 of the UTF-8 text with A-Z lower-cased; bytes.lower() touches nothing else."""
    return hashlib.sha256(text.encode("utf-8", "surrogatepass").lower() if text else b"").digest()


@F.pandas_udf(T.BinaryType())
def normalised_sha256(text: pd.Series) -> pd.Series:
    return text.map(text_sha256)


def slot_of(hashes: pd.Series, bits: int) -> np.ndarray:
    first = np.frombuffer(b"".join(h[:8] for h in hashes), dtype="<u8")
    return (first & np.uint64(bits - 1)).astype(np.int64)


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    return min(max_bits, max(SEGMENT, 1 << (max(rows, 1) * BITS_PER_ROW - 1).bit_length()))


def repeated_slots(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Pass one: a packed bitmap of the slots that two or more rows hit.

    Each task sends, per segment of 65,536 slots, the slots it hit and those it hit twice, two bytes each; segments are
    merged apart from each other. The driver gets at most bits / 8 bytes.
    """

    def of_task(frames):
        slots = [slot_of(f[column], bits) for f in frames if len(f)]
        if not slots:
            return
        hit, times = np.unique(np.concatenate(slots), return_counts=True)
        cuts = np.flatnonzero(np.diff(hit // SEGMENT)) + 1
        parts = zip(np.split(hit, cuts), np.split(times, cuts))
        rows = [(int(h[0] // SEGMENT), (h % SEGMENT).astype("<u2").tobytes(),
                 (h[t > 1] % SEGMENT).astype("<u2").tobytes()) for h, t in parts]
        yield pd.DataFrame(rows, columns=["segment", "once", "twice"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        once = np.frombuffer(b"".join(frame["once"]), dtype="<u2")
        twice = np.bincount(once, minlength=SEGMENT) > 1
        twice[np.frombuffer(b"".join(frame["twice"]), dtype="<u2")] = True
        packed = np.packbits(twice, bitorder="little").tobytes()
        return pd.DataFrame({"segment": frame["segment"].iloc[:1], "packed": [packed if twice.any() else b""]})

    merged = (hashes.select(column).mapInPandas(of_task, "segment int, once binary, twice binary")
              .groupBy("segment").applyInPandas(merge, "segment int, packed binary")
              .where(F.length("packed") > 0))
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():
        start = row.segment * SEGMENT // 8
        bitmap[start:start + SEGMENT // 8] = np.frombuffer(row.packed, dtype=np.uint8)
    return bitmap


def possibly_repeated(hashes: DataFrame, column: str, rows: int, max_bits: int = MAX_BITS):
    """Column expressions for pass two: may this row's hash occur again? And the same from the text, with its hash."""
    bits = filter_bits(rows, max_bits)
    bitmap = hashes.sparkSession.sparkContext.broadcast(repeated_slots(hashes, column, bits))

    def found(hash_: pd.Series) -> np.ndarray:
        slots = slot_of(hash_, bits)
        return (bitmap.value[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1

    @F.pandas_udf(T.BooleanType())
    def look_up(hash_: pd.Series) -> pd.Series:
        return pd.Series(found(hash_))

    @F.pandas_udf(T.StructType([T.StructField("hash", T.BinaryType()), T.StructField("maybe", T.BooleanType())]))
    def look_up_text(text: pd.Series) -> pd.DataFrame:  # one Python worker a task, not one per function
        hash_ = text.map(text_sha256)
        return pd.DataFrame({"hash": hash_, "maybe": found(hash_)})

    # Filters on it must not be pushed below the column: they would evaluate it a second time, in a second worker.
    return look_up.asNondeterministic(), look_up_text.asNondeterministic()


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    thin = written(docs.select(F.col(key).alias("doc_id"), normalised_sha256(text).alias("hash"),
                               F.monotonically_increasing_id().alias("row")), "hashes")
    maybe, _ = possibly_repeated(thin, "hash", thin.count(), max_bits)
    marked = thin.withColumn("maybe", maybe("hash"))
    alone = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "hash")
    rest = marked.where("maybe").select("doc_id", "row", "hash")
    # Written, so that the join meets two shuffled sides: then Spark cuts the partition of a very large group.
    groups = written(rest.groupBy("hash").agg(F.count(F.lit(1)).alias("group_size"),
                                              F.max(F.struct("doc_id", "row")).alias("last")), "hashes")
    grouped = rest.join(groups, "hash").select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"), "hash")
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("hash")).alias("text_sha256"))


def keep_last(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    Rows that the filter finds alone go straight through with their texts. Of the others each task keeps one row per
    hash before the shuffle.
    """
    columns = docs.columns
    hashes = written(docs.select(normalised_sha256(text).alias("hash")), "hashes")
    _, maybe = possibly_repeated(hashes, "hash", hashes.count(), max_bits)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("body"), maybe(text).alias("found")).select(
        "body", "found.*")
    alone = marked.where(~F.col("maybe")).select("body")
    plain = [f"body.`{f.name}`" for f in docs.schema.fields
             if f.dataType.typeName() in ("byte", "short", "integer", "long", "double", "float", "string", "boolean")]
    order = F.struct(F.col(f"body.`{key}`"), F.xxhash64(*plain) if plain else F.lit(0))
    last = marked.where("maybe").groupBy("hash").agg(F.max_by("body", order).alias("body")).select("body")
    return alone.unionByName(last).select("body.*")


SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)
"""
