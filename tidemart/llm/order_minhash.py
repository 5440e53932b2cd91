"""Order MinHash: fingerprints whose likeness follows the edit distance, not only the shared content.

The k-mers of a text are numbered by occurrence, so that a repeated one counts as often as it occurs. For each of SIZE
hash functions the PICKS least of them are selected, put back into text order, and hashed as a tuple. Two texts agree in
a function only where they share the selected k-mers and their order. The likeness is the share of functions that agree.

Null texts are empty. Texts shorter than K are one k-mer; the empty text has a fingerprint of its own. Equal texts have
equal fingerprints. Any text is taken whole, in about 40 bytes of memory a character.

`compare_neighbours` sorts documents by descending id (nulls last, ties by a hash of the text) and compares each with
its edit and with the document that follows. Documents are dealt by id ranges and sorted within; each task reads its range
once and holds one document. The first and last document of each range are written out, and joined with those of the next
range. Texts go through the shuffle once, compressed one by one; only a few per range go on. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty, written

K = 6
SIZE = 64
PICKS = 2
STRIDE = 4096
RANGE_BYTES = 16 << 20
U64, U32 = np.uint64, np.uint32
_random = np.random.default_rng(20)
FACTORS = (_random.integers(0, 1 << 32, SIZE, dtype=np.uint64) | U64(1)).astype(U32)[:, None]
OFFSETS = _random.integers(0, 1 << 32, SIZE, dtype=np.uint64).astype(U32)[:, None]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """One hash per k-mer and occurrence number, in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U64)
    n = max(1, len(points) - k + 1)
    h = np.full(n, U64(len(points) if len(points) < k else k), U64)
    for j in range(min(k, len(points))):
        h = h * U64(0x9E3779B97F4A7C15) + points[j:j + n] + U64(1)
    h = mixed(h)
    ordered = np.sort(h)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(repeated):
        place = np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)
        at = np.flatnonzero(repeated[place] == h)
        order = np.argsort(place[at], kind="stable")
        group = place[at][order]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        number = np.empty(len(at), np.int64)
        number[order] = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        h[at] = mixed(h[at] + number.astype(U64) * U64(0xD6E8FEB86659FD93))
    return h


def signature(text: str, k: int = K) -> np.ndarray:
    """SIZE values of 16 bits."""
    kmers = numbered_kmers(text, k)
    short = (kmers >> U64(32)).astype(U32)
    rows = np.arange(SIZE)
    picks = min(PICKS, len(kmers))
    values, places = [], []
    for i in range(0, len(short), STRIDE):
        hashed = short[None, i:i + STRIDE] * FACTORS + OFFSETS
        hashed ^= hashed >> U32(15)
        for _ in range(min(picks, hashed.shape[1])):
            at = hashed.argmin(axis=1)
            values.append(hashed[rows, at])
            places.append(at + i)
            hashed[rows, at] = U32(0xFFFFFFFF)
    value, place = np.stack(values, axis=1), np.stack(places, axis=1)
    if value.shape[1] > picks:  # the least of all strides; the earlier one of equal values
        order = np.argsort(value, axis=1, kind="stable")[:, :picks]
        place = np.take_along_axis(place, order, axis=1)
    place.sort(axis=1)
    out = np.full(SIZE, U64(len(kmers) if len(kmers) < PICKS else PICKS), U64)
    for j in range(picks):
        out = mixed(out * U64(0x9E3779B97F4A7C15) + kmers[place[:, j]])
    return (out >> U64(48)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def as_bytes(values: np.ndarray) -> bytes:
    return values.astype(">u2").tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">u2")


def as_text(values: np.ndarray) -> str:
    return as_bytes(values).hex()


@F.pandas_udf(T.BinaryType())
def compressed(text: pd.Series) -> pd.Series:
    pack = zstandard.ZstdCompressor(level=3).compress
    return text.map(lambda t: pack(t.encode("utf-8", "surrogatepass")))


def edited(text: str, next_: str) -> str:
    """The last half of the code points replaced by as many first ones of the next text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + next_[:half]


def _result(text: str, own: np.ndarray, next_: str, after: np.ndarray) -> tuple:
    edit = edited(text, next_)
    changed = signature(edit)
    return (len(text), hashlib.sha256(edit.encode("utf-8", "surrogatepass")).digest(), as_bytes(own), as_bytes(changed),
            likeness(own, changed), likeness(own, after))


RESULT = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, "
          "near_next double")
RESULT_FIELDS = [("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()),
                 ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
HEX = ("edited_sha256", "fingerprint", "edited_fingerprint")


def _range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents in; a result for each but the last, and the first and last as they are (edge f, l)."""
    part, held, schema = TaskContext.get().partitionId(), None, None
    unpack = zstandard.ZstdDecompressor().decompress
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(schema)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        schema = schema or pa.schema([("doc_id", batch.schema.field(0).type), *RESULT_FIELDS, ("part", pa.int64()),
                                      ("edge", pa.string()), ("text", pa.string())])
        for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = unpack(data).decode("utf-8", "surrogatepass")
            own = signature(text)
            if held is None:
                rows.append((doc_id, len(text), None, as_bytes(own), None, None, None, part, "f", text))
            else:
                rows.append((held[0], *_result(held[1], held[2], text, own), part, None, None))
            held = doc_id, text, own
            if len(rows) >= 2000:
                yield out()
    if held is not None:
        rows.append((held[0], len(held[1]), None, as_bytes(held[2]), None, None, None, part, "l", held[1]))
        yield out()


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, prints, next_texts, next_prints = (batch.column(i).to_pylist() for i in range(5))
        found = [(i, *_result(t, from_bytes(p), nt, from_bytes(np_)))
                 for i, t, p, nt, np_ in zip(ids, texts, prints, next_texts, next_prints)]
        schema = pa.schema([("doc_id", batch.schema.field(0).type), *RESULT_FIELDS])
        columns = list(zip(*found)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    thin = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    size = thin.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    parts = max(1, -(-size // range_bytes))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    packed = thin.select("doc_id", compressed("text").alias("packed"), F.xxhash64("text").alias("tie"))
    id_type = thin.schema["doc_id"].dataType.simpleString()
    done = written(packed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie").mapInArrow(
        _range, f"doc_id {id_type}, {RESULT}, part long, edge string, text string"), "neighbours")
    inner = done.where(F.col("edge").isNull()).drop("part", "edge", "text")
    first = done.where("edge = 'f'").select(F.col("part").alias("next"), F.col("text").alias("next_text"),
                                            F.col("fingerprint").alias("next_print"))
    follows = first.select("next").select(  # one row per range: a task of its own is enough
        F.col("next").alias("part"), F.coalesce(F.lead("next").over(Window.orderBy("next")),
                                                F.min("next").over(Window.partitionBy())).alias("next"))
    last = done.where("edge = 'l'").join(follows, "part").join(first, "next").select(
        "doc_id", "text", "fingerprint", "next_text", "next_print")
    found = inner.unionByName(last.mapInArrow(_stitch, f"doc_id {id_type}, {RESULT}"))
    return found.withColumns({c: F.lower(F.hex(c)) for c in HEX})
