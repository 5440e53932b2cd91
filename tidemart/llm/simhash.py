"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits, by bit-sliced comparison.

Candidates share two of five bit groups: three differing bits leave at least two groups untouched, so no link is lost.
A candidate bucket is compared with its fingerprints stored as vertical bit planes: one 64-bit word holds one bit of 64
fingerprints. Differences are counted in carry-save counters, and words whose 64 fingerprints all exceed the radius
are left out of the remaining planes. A bucket of more than BLOCK fingerprints is cut into blocks, and each pair of
blocks is a task of its own. Of a compared block only a spanning forest of its links goes on, never its pairs.

Equal fingerprints are one vertex. A text without words (null, empty, white space) has fingerprint zero and is linked
like any other. component_id is the smallest doc_id that can be reached (null where no document of the group has an id).
An empty table gives an empty result. Columns of the input other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
GROUPS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit and width
BLOCK = 2048
SMALL = 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
SLAB = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - shingle + 1]
    ends = ends[shingle - 1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), SLAB):
        cuts = zip(starts[i:i + SLAB].tolist(), ends[i:i + SLAB].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cuts], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _simhash(text: pd.Series) -> pd.Series:
    prints = [fingerprint(t.encode("utf-8", "surrogatepass") if t else b"") for t in text]
    return pd.Series(np.array(prints, dtype=np.uint64).view(np.int64))


# The fingerprint as a signed long. It depends on the text alone, but filters on it (such as a join's test for null) must not
# be pushed below the column: they would evaluate it a second time, in a second Python worker.
simhash = _simhash.asNondeterministic()


def planes(prints: np.ndarray) -> np.ndarray:
    """64 x words: bit k of word w in plane j is bit j of fingerprint 64 w + k."""
    full = np.zeros(-(-len(prints) // 64) * 64, dtype="<u8")
    full[:len(prints)] = prints
    bits = np.unpackbits(full.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def beyond(plane, n: int, radius: int = RADIUS) -> np.ndarray:
    """n words; a set bit means more than `radius` set bits in its column. plane(j, alive) gives plane j of living words.

    The counters are bit planes themselves: adding a plane is a half adder per counter bit, and a carry out of the
    last one, or a count above the radius, sets the overflow bit for good. After every eighth plane, words with all
    columns beyond the radius are dropped.
    """
    width = (radius + 1).bit_length()
    out, alive = np.full(n, ALL), np.arange(n)
    counters, over = [np.zeros(n, np.uint64) for _ in range(width)], np.zeros(n, np.uint64)
    for j in range(64):
        carry = plane(j, alive)
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if j % 8 == 7:
            more, same = over.copy(), np.full(len(alive), ALL)
            for k in reversed(range(width)):  # counter > radius, bit by bit from the top
                if radius >> k & 1:
                    same &= counters[k]
                else:
                    more |= same & counters[k]
                    same &= ~counters[k]
            over = more
            keep = over != ALL
            if not keep.all():
                alive, over, counters = alive[keep], over[keep], [c[keep] for c in counters]
            if not len(alive):
                return out
    out[alive] = over
    return out


def near_rows(prints: np.ndarray, first: int, last: int, vertical: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Links of fingerprints first..last to all: a bit matrix, last - first rows of words."""
    words, own = vertical.shape[1], prints[first:last]
    row, word = np.repeat(np.arange(last - first), words), np.tile(np.arange(words), last - first)

    def plane(j, alive):
        bit = (own[row[alive]] >> np.uint64(j)) & np.uint64(1)
        return vertical[j][word[alive]] ^ (ALL * bit)

    return ~beyond(plane, len(row), radius).reshape(last - first, words)


def forest(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Pairs (fingerprint, smallest of its component) among many distinct fingerprints."""
    prints = np.sort(prints)
    n, vertical = len(prints), planes(prints)
    step = max(1, (1 << 17) // vertical.shape[1])
    links = np.concatenate([near_rows(prints, i, min(n, i + step), vertical, radius) for i in range(0, n, step)])
    free = planes(np.full(n, ALL, dtype=np.uint64))[0]  # one bit per fingerprint that no component has yet
    pairs = []
    for i in range(n):
        if not free[i >> 6] >> np.uint64(i & 63) & np.uint64(1):
            continue
        reached = np.zeros_like(free)
        reached[i >> 6] = np.uint64(1) << np.uint64(i & 63)
        free &= ~reached
        todo = [i]
        while todo:
            new = links[todo.pop()] & free
            if new.any():
                free &= ~new
                reached |= new
                todo += np.flatnonzero(np.unpackbits(new.view(np.uint8), bitorder="little")).tolist()
        members = np.flatnonzero(np.unpackbits(reached.view(np.uint8), bitorder="little"))[1:]
        if len(members):
            pairs.append(np.stack([prints[members], np.full(len(members), prints[i])], axis=1))
    return np.concatenate(pairs) if pairs else np.zeros((0, 2), np.uint64)


def small_links(key: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Linked pairs within runs of equal keys of at most SMALL rows each, all runs at once."""
    found = []
    for step in range(1, SMALL):
        at = np.flatnonzero(key[:-step] == key[step:]) if len(key) > step else np.zeros(0, np.int64)
        if not len(at):
            break
        for i in range(0, len(at), 1 << 20):
            some = at[i:i + (1 << 20)]
            vertical = planes(prints[some] ^ prints[some + step])
            over = beyond(lambda j, alive: vertical[j][alive], vertical.shape[1], radius)
            near = some[np.unpackbits((~over).view(np.uint8), bitorder="little")[:len(some)].astype(bool)]
            found.append(np.stack([prints[near], prints[near + step]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


def compare_runs(batches: Iterator[pa.RecordBatch], radius: int = RADIUS) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, fingerprint) sorted by bucket and fingerprint in; links out. A run has at most 2 x BLOCK rows."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (prints[1:] != prints[:-1])
        key, prints = key[fresh], prints[fresh]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        large = np.repeat(sizes > SMALL, sizes)
        pairs = [small_links(key[~large], prints[~large], radius)]
        pairs += [forest(prints[s:s + n], radius) for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL])]
        both = np.unique(np.concatenate(pairs), axis=0).astype(np.uint64).view(np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], schema=schema)

    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        held_key = np.concatenate([held_key, batch.column(0).to_numpy(zero_copy_only=False)])
        held = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if len(held_key) < 100_000 or held_key[0] == held_key[-1]:
            continue
        cut = int(np.searchsorted(held_key, held_key[-1]))  # the last run may go on
        yield links(held_key[:cut], held[:cut])
        held_key, held = held_key[cut:], held[cut:]
    if len(held_key):
        yield links(held_key, held)


def near_links(prints: DataFrame, column: str = "print", radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the radius, directly or through others."""
    keys = []
    for i, pair in enumerate(combinations(GROUPS, 2)):
        key = F.lit(i).cast("long")
        for first, width in pair:
            key = F.shiftleft(key, width).bitwiseOR(
                F.shiftrightunsigned(F.col(column), first).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
        keys.append(key)
    spread = prints.select(F.col(column).alias("print")).select(F.explode(F.array(*keys)).alias("bucket"), "print")
    # Buckets beyond a block: every pair of its blocks becomes a bucket of its own, numbered from the hash of the three.
    sizes = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cut = spread.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long")))
                      .otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).alias("other")
    own = F.when(F.col("blocks") == 1, F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("print"), F.col("blocks")))
    tasks = cut.select("bucket", "print", "blocks", own.alias("own"), other).select(
        F.when(F.col("blocks") == 1, F.col("bucket")).otherwise(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))).alias("run"), "print")
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (tasks.repartition(n, "run").sortWithinPartitions("run", "print")
            .mapInArrow(lambda batches: compare_runs(batches, radius), "a long, b long"))


def near_groups(thin: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(print, root, members, component_id) per distinct fingerprint, from written rows (doc_id, print).

    root names the component, members counts its documents, component_id is the smallest of their ids.
    """
    prints = written(thin.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "fingerprints")
    roots = components(near_links(prints, "print", radius))
    rooted = prints.join(roots.withColumnRenamed("a", "print"), "print", "left").select(
        "print", "least", "n", F.coalesce("b", "print").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("members"))
    return rooted.drop("least", "n").join(groups, "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    thin = written(docs.select(F.col(key).alias("doc_id"), simhash(text).alias("print")), "fingerprints")
    return thin.join(near_groups(thin, radius), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of docs without near copies, all columns: of each group the row with the smallest id (null ids last,
    then by a hash of the text) stays.

    Documents alone in their group meet one row of the groups and go on; of the others each task keeps one row per
    group before they are shuffled.
    """
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("body"),
                       F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), simhash(text).alias("print"))
    thin = written(body.select("doc_id", "print"), "fingerprints")
    groups = written(near_groups(thin, radius).where("members > 1").select("print", "root"), "fingerprints")
    met = body.join(groups, "print", "left")
    alone = met.where(F.col("root").isNull()).select("body")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"))
    first = met.where(F.col("root").isNotNull()).groupBy("root").agg(F.min_by("body", order).alias("body")).select("body")
    return alone.unionByName(first).select("body.*")
