"""N-gram Jaccard join: which documents share at least 90 % of their distinct word shingles.

Rare-first prefix filtering. All shingles of a document are put in one order, the rarest of the corpus first. Two sets
that are alike enough must share a shingle among the first few of both, so only these prefixes are joined. A pair that
meets passes a length filter, a positional filter (how many shingles are left behind the one they share) and a suffix
filter (the shingles left are counted between fixed pivots; the differences of the counts bound the distance from
below), and is then verified once, shingle by shingle.

Scale. Frequencies are counted over all documents: a block of documents asks hash ranges for the frequencies of its distinct
shingles, a few bytes each. Shingles that occur in one document join nothing and stop here; of usual texts little else is
left in a prefix. Documents with equal sets go on as one. A prefix bucket never emits its pairs: it is compared in blocks of
BLOCK sets, each pair of blocks a bucket of its own, and only a spanning forest of the pairs that pass all filters goes on.
The trees join to groups of candidates. A group's sets come together once, in parts of PART shingles, each pair of parts
a task of its own; a pair of sets is verified in the one task that has its two parts, unless links found there connect it
already. So no link between different texts is lost, and copies are not multiplied out.

A null text has no words; a set without shingles is linked with nothing. With fewer words than a shingle has, the whole
sequence is the one shingle. component_id is the smallest doc_id reachable by links, null if none of the group has an id;
repeated rows are documents of their own with equal sets. An empty table gives an empty result. Only the columns named are
read. Shingles are compared by 64-bit hashes, sets are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs, text_or_empty, written
from .components import components
from .lm import U64, packed, packed_sorted, ranges_of, unpacked, unpacked_sorted
from .substrings import BASE, INVERSE, mixed, powers

SHINGLE = 3
SHARE = (90, 100)
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 32 << 20
BLOCK = 1024
PART = 1 << 20
BINS = 16
SLAB = 1 << 20
SALT = tuple(U64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


# Shingles of texts ----------------------------------------------------------------------------------------------------

_random = np.random.default_rng(13)
_VALUE = _random.integers(0, 1 << 64, 256, dtype=U64)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWER, _INVERSE = powers(BASE, SLAB + 1), powers(INVERSE, SLAB + 1)


def _long_word(word: bytes) -> np.uint64:
    """The same hash as below of a word longer than a slab."""
    total, base = 0, 1
    step = pow(BASE, SLAB, 1 << 64)
    for i in range(0, len(word), SLAB):
        own = np.frombuffer(word[i:i + SLAB], np.uint8)
        total += base * int((_VALUE[own] * _POWER[:len(own)]).sum(dtype=U64))
        base = base * step % (1 << 64)
    return U64(total % (1 << 64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and end of each word, A-Z as a-z: sums of random values of the bytes times powers of a base, from prefix sums."""
    if len(data) > SLAB:
        words = data.split()
        return mixed(np.array([_long_word(w) for w in words], U64)), np.full(len(words), len(data))
    own = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(_IS_SPACE[own], prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(own) + 1, U64)
    np.cumsum(_VALUE[own] * _POWER[:len(own)], dtype=U64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _INVERSE[starts]), ends


def all_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, one after the other, and how many each text has."""
    hashes, counts = [np.zeros(0, U64)], np.zeros(len(texts), np.int64)
    held, size = [], 0

    def flush() -> None:
        if held:
            found, ends = word_hashes(b" ".join(texts[i] for i in held))
            last = np.cumsum([len(texts[i]) + 1 for i in held])
            counts[held] = np.diff(np.searchsorted(ends, last), prepend=0)
            hashes.append(found)
            held.clear()

    for i, text in enumerate(texts):
        if size + len(text) + 1 > SLAB:
            flush()
            size = 0
        if len(text) < SLAB:
            held.append(i)
            size += len(text) + 1
            continue
        for piece in slabs(text, SLAB // 2):
            found, _ = word_hashes(piece)
            hashes.append(found)
            counts[i] += len(found)
    flush()
    return np.concatenate(hashes), counts


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one document."""
    n = min(size, len(words))
    if not n:
        return np.zeros(0, U64)
    sums = np.full(len(words) - n + 1, U64(n), U64)
    for i in range(n):
        sums = sums * SALT[0] + mixed(words[i:len(words) - n + 1 + i] ^ SALT[1])
    out = np.sort(mixed(sums))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


class Sets:
    """Shingle sets of a block's documents, one after the other."""

    def __init__(self, rows: pa.Table, size: int):
        words, counts = all_words(rows.column("text").cast(pa.binary()).to_pylist())
        ends = np.cumsum(counts).tolist()
        own = [shingles(words[a:b], size) for a, b in zip([0, *ends], ends)]
        self.length = np.fromiter(map(len, own), np.int64, len(own))
        self.hashes = np.concatenate([np.zeros(0, U64), *own])
        self.doc = np.repeat(np.arange(len(own)), self.length)


# Frequencies ----------------------------------------------------------------------------------------------------------

def _keys(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (the top bits of a hash) in order, and how many documents of the block have each."""
    keys = np.sort(hashes >> U64(64 - width))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


ASK = "block long, range long, keys binary, counts binary"


def _ask(size: int, width: int, bits: int):
    def ask(rows: pa.Table) -> pa.Table:
        keys, counts = _keys(Sets(rows, size).hashes, width)
        own = ranges_of(keys << U64(64 - width), bits)
        cuts = np.flatnonzero(np.diff(own, prepend=-1)).tolist()
        out = [(int(own[a]), packed_sorted(keys[a:b]), packed(counts[a:b].astype("<u4")))
               for a, b in zip(cuts, [*cuts[1:], len(own)])]
        columns = list(zip(*out)) or [[], [], []]
        block = rows.column("block")[0].as_py()
        return pa.table([pa.array([block] * len(out), pa.int64()), pa.array(columns[0], pa.int64()),
                         pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
                        names=["block", "range", "keys", "counts"])

    return ask


def _answer(rows: pa.Table) -> pa.Table:
    """The sums over all blocks, for each block in the order in which it asked."""
    keys = [unpacked_sorted(k) for k in rows.column("keys").to_pylist()]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unpacked(c, "<u4") for c in rows.column("counts").to_pylist()])
    total = np.bincount(place, weights=counts, minlength=len(distinct)).astype("<u4")
    parts = np.split(total[place], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table([rows.column("block"), rows.column("range"), pa.array([packed(p) for p in parts], pa.binary())],
                    names=["block", "range", "counts"])


# Prefixes -------------------------------------------------------------------------------------------------------------

def needed(n: np.ndarray | int, share: tuple[int, int]):
    """The least number of shingles that a set of n shares with any set it is linked to."""
    return -(-share[0] * n // share[1])


def overlap(both: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The least number of shingles that two linked sets share, by the sum of their sizes."""
    return -(-share[0] * both // (share[0] + share[1]))


def binned(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(60)).astype(np.int64)


PREFIX = "doc_id long, n_shingles long, s1 long, s2 long, tokens binary, places binary, left binary, ordered binary"


def _prefixes(size: int, width: int, share: tuple[int, int]):
    """Per document its set's size and digest; where its prefix has shingles of other documents, these, their places in the
    order, the counts of what is left behind each between pivots, and the whole set in order."""
    def prefixes(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([[]] * 8, schema=schema)
        sets = Sets(rows, size)
        answers = answers.sort_by("range")
        counts = np.concatenate([np.zeros(0, "<u4"), *(unpacked(c, "<u4") for c in answers.column("counts").to_pylist())])
        keys, _ = _keys(sets.hashes, width)
        count = counts[np.searchsorted(keys, sets.hashes >> U64(64 - width))] if len(keys) else counts
        n, docs = sets.length, len(sets.length)
        ends = np.cumsum(n)
        digest = [np.add.reduceat(np.append(mixed(sets.hashes ^ s), U64(0)), np.minimum(ends - n, len(sets.hashes))) for s in SALT[1:]]
        digest = [np.where(n > 0, d, U64(0)).view(np.int64) for d in digest]
        length = np.where(n > 0, n - needed(n, share) + 1, 0)
        alone = np.bincount(sets.doc, weights=count == 1, minlength=docs)
        out: list[list] = [[None] * docs for _ in range(4)]
        for i in np.flatnonzero(alone < length).tolist():
            a, b = int(ends[i] - n[i]), int(ends[i])
            order = np.lexsort((sets.hashes[a:b], count[a:b]))
            ordered, often = sets.hashes[a:b][order], count[a:b][order]
            p = int(length[i])
            at = np.flatnonzero(often[:p] > 1)
            seen = np.zeros((p + 1, BINS), np.int64)
            seen[np.arange(1, p + 1), binned(ordered[:p])] = 1
            left = np.bincount(binned(ordered), minlength=BINS) - np.cumsum(seen, axis=0)[at + 1]
            out[0][i], out[1][i] = ordered[at].astype("<u8").tobytes(), at.astype("<i4").tobytes()
            out[2][i], out[3][i] = np.minimum(left, 65535).astype("<u2").tobytes(), ordered.astype("<u8").tobytes()
        return pa.table([rows.column("doc_id"), pa.array(n), *map(pa.array, digest),
                         *(pa.array(c, pa.binary()) for c in out)], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("tokens", pa.binary()), ("places", pa.binary()), ("left", pa.binary()), ("ordered", pa.binary())])
    return prefixes


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, vertex, n, place, left): a row per shingle of a prefix."""
    for batch in batches:
        vertex, n, tokens, places, left = (c.to_pylist() for c in batch.columns)
        sizes = np.array([len(t) // 8 for t in tokens])
        bins = b"".join(left)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.frombuffer(b"".join(tokens), "<i8")), pa.array(np.repeat(np.array(vertex, np.int64), sizes)),
            pa.array(np.repeat(np.array(n, np.int64), sizes)), pa.array(np.frombuffer(b"".join(places), "<i4").astype(np.int64)),
            pa.array([bins[i:i + 2 * BINS] for i in range(0, len(bins), 2 * BINS)], pa.binary())],
            names=["token", "vertex", "n", "place", "left"])


# Candidates -----------------------------------------------------------------------------------------------------------

def pass_filters(n, place, left, i: np.ndarray, j: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether rows i and j of one shingle may be a pair that has this as its first common shingle."""
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    least = overlap(n[i] + n[j], share)
    ok = (small >= needed(large, share)) & (1 + np.minimum(n[i] - place[i], n[j] - place[j]) - 1 >= least)
    at = np.flatnonzero(ok)
    far = np.abs(left[i[at]].astype(np.int32) - left[j[at]]).sum(axis=1)
    ok[at] = place[i[at]] + place[j[at]] + far <= (n[i] + n[j] - 2 * least)[at]
    return ok


class Forest:
    """Union of numbers, smaller ones on top."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def tops(self, of: np.ndarray) -> np.ndarray:
        up = self.up
        while True:
            higher = up[up[of]]
            if (higher == up[of]).all():
                return higher
            up[of] = higher

    def join(self, i: int, j: int) -> bool:
        a, b = (int(x) for x in self.tops(np.array([i, j])))
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forest_of_run(vertex, n, place, left, share) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what passes the filters, of one run."""
    size, forest, pairs = len(vertex), Forest(len(vertex)), []
    step = max(1, (1 << 18) // size)
    for a in range(0, size, step):
        i, j = np.meshgrid(np.arange(a, min(size, a + step)), np.arange(size), indexing="ij")
        i, j = i[i < j], j[i < j]
        tops = forest.tops(np.arange(size))
        apart = (tops[i] != tops[j]) & (vertex[i] != vertex[j])
        i, j = i[apart], j[apart]
        near = pass_filters(n, place, left, i, j, share)
        for x, y in zip(i[near].tolist(), j[near].tolist()):
            if forest.up[x] != forest.up[y] and forest.join(x, y):
                pairs.append((x, y))
    found = np.array(pairs, np.int64).reshape(-1, 2)
    return vertex[found[:, 0]], vertex[found[:, 1]]


def _candidates(share: tuple[int, int]):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(run, vertex, n, place, left) -> pa.RecordBatch:
        starts = np.flatnonzero(np.diff(run, prepend=run[0] - 1))
        sizes = np.diff(np.append(starts, len(run)))
        few = np.repeat(sizes <= 8, sizes)
        found = []
        for step in range(1, 8):  # all small runs at once
            i = np.flatnonzero(few[:-step] & (run[:-step] == run[step:]))
            i = i[vertex[i] != vertex[i + step]]
            i = i[pass_filters(n, place, left, i, i + step, share)]
            found.append((vertex[i], vertex[i + step]))
        found += [_forest_of_run(*(x[s:s + size] for x in (vertex, n, place, left)), share)
                  for s, size in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist())]
        pairs = np.stack([np.concatenate(x) for x in zip(*found)], axis=1)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (run, vertex, n, place, left) sorted by run; a run has at most 2 BLOCK rows or so."""
        held = [np.zeros(0, np.int64)] * 4 + [np.zeros((0, BINS), np.uint16)]
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]]
            new.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), "<u2").reshape(-1, BINS))
            held = [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) < 50_000 or held[0][0] == held[0][-1]:
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last run may go on
            yield links(*(x[:cut] for x in held))
            held = [x[cut:] for x in held]
        if len(held[0]):
            yield links(*held)

    return compare


def _runs(rows: DataFrame, parts: str, key: str, vertex: str = "vertex") -> DataFrame:
    """Deals the rows of a key with several parts to every pair of parts: columns run, own, and whether `one` part meets itself."""
    own = F.pmod(F.xxhash64(F.lit(parts), vertex), F.col(parts))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1)).alias("other")
    dealt = rows.withColumn("own", own).select("*", other)
    return dealt.withColumns({
        "run": F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other")), "one": F.col("own") == F.col("other")})


def candidate_links(sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b) of vertices that connect all pairs that pass the filters, directly or through others."""
    prefix = sets.select("vertex", "n", "tokens", "places", "left").mapInArrow(
        _spread, "token long, vertex long, n long, place long, left binary")
    sizes = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    spread = prefix.join(sizes, "token").withColumn("parts", F.ceil(F.col("size") / BLOCK))
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _runs(spread, "parts", "token").select("run", "vertex", "n", "place", "left")
    return dealt.repartition(n, "run").sortWithinPartitions("run", "vertex").mapInArrow(_candidates(share), "a long, b long")


# Verification ---------------------------------------------------------------------------------------------------------

def _verified(rows: pa.Table, share: tuple[int, int]) -> np.ndarray:
    """Links among the sets of a task, each pair verified at most once; those that links found here connect are passed over.

    Sets come in by ascending size; each looks up its prefix in the index of those before it."""
    n = rows.column("n").to_numpy()
    order = np.lexsort((rows.column("vertex").to_numpy(), n))
    vertex, n, own = rows.column("vertex").to_numpy()[order], n[order], rows.column("own").to_numpy()[order]
    one = bool(rows.column("one")[0].as_py())
    data = rows.column("ordered").to_pylist()
    sets = [np.frombuffer(data[i], "<u8") for i in order.tolist()]
    bins = np.stack([np.bincount(binned(s), minlength=BINS) for s in sets])
    length = n - needed(n, share) + 1
    index: dict[int, list[tuple[int, int]]] = {}
    forest, found = Forest(len(sets)), []
    for x, own_set in enumerate(sets):
        prefix = own_set[:length[x]].tolist()
        met = [(y, place, i) for i, token in enumerate(prefix) for y, place in index.get(token, ())]
        if met:
            y, theirs, mine = np.array(met, np.int64).T
            y, first = np.unique(y, return_index=True)  # the first shingle in common
            least = overlap(n[x] + n[y], share)
            ok = (n[y] >= needed(n[x], share)) & (1 + np.minimum(n[x] - mine[first], n[y] - theirs[first]) - 1 >= least)
            ok &= np.abs(bins[y] - bins[x]).sum(axis=1) <= n[x] + n[y] - 2 * least
            if not one:
                ok &= own[y] != own[x]
            y, least = y[ok], least[ok]
            known, tries = np.sort(own_set), 1
            while len(y):  # of each group of linked sets the first few, then more
                tops = forest.tops(y)
                apart = tops != forest.tops(np.array([x]))[0]
                y, least, tops = y[apart], least[apart], tops[apart]
                by = np.argsort(tops, kind="stable")
                y, least, tops = y[by], least[by], tops[by]
                starts = np.flatnonzero(np.diff(tops, prepend=-1))
                rank = np.arange(len(y)) - np.repeat(starts, np.diff(np.append(starts, len(y))))
                now = rank < tries
                if now.any():
                    some = [sets[i] for i in y[now].tolist()]
                    tokens = np.concatenate(some)
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    cuts = np.cumsum([0, *map(len, some)])[:-1]
                    shared = np.add.reduceat((known[at] == tokens).astype(np.int64), cuts)
                    for i in y[now][shared >= least[now]].tolist():
                        if forest.join(x, i):
                            found.append((vertex[x], vertex[i]))
                y, least, tries = y[~now], least[~now], 2 * tries
        for place, token in enumerate(prefix):
            index.setdefault(token, []).append((x, place))
    return np.array(found, np.int64).reshape(-1, 2)


def _verify(share: tuple[int, int]):
    def verify(rows: pa.Table) -> pa.Table:
        links = _verified(rows, share)
        return pa.table({"a": links[:, 0].copy(), "b": links[:, 1].copy()})

    return verify


def verified_links(sets: DataFrame, groups: DataFrame, share: tuple[int, int], part: int) -> DataFrame:
    """(a, b) that connect all linked sets. groups: a, b as `components` gives them."""
    spark = sets.sparkSession
    roots = groups.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(
        groups.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
    thin = written(sets.select("vertex", "n").join(roots, "vertex"), "candidates")
    sizes = thin.groupBy("root").agg(F.ceil(F.sum("n") / part).alias("parts"))
    tasks = written(_runs(thin.join(sizes, "root"), "parts", "root").select("vertex", "run", "own", "one"), "candidates")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (sets.select("vertex", "n", "ordered").join(tasks, "vertex").repartition(n, "run").groupBy("run")
            .applyInArrow(_verify(share), "a long, b long"))


# The join -------------------------------------------------------------------------------------------------------------

def shingle_sets(docs: DataFrame, key: str, text: str, size: int, share: tuple[int, int], block_bytes: int = BLOCK_BYTES,
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """PREFIX, one row per document, written."""
    thin = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_or_empty(f"`{text}`").alias("text"))
    total, rows = thin.agg(F.sum(F.octet_length("text").cast("long")), F.count(F.lit(1))).first()
    total, blocks = total or 0, max(1, -(-(total or 0) // block_bytes), -(-rows // 50_000))
    bits = (max(1, -(-total // range_bytes)) - 1).bit_length()
    width = min(48, max(24, total.bit_length() + 11, bits + 1))
    dealt = thin.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(blocks, "block")
    answers = (dealt.groupBy("block").applyInArrow(_ask(size, width, bits), ASK).repartition(1 << bits, "range")
               .groupBy("range").applyInArrow(_answer, "block long, range long, counts binary"))
    return written(dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _prefixes(size, width, share), PREFIX), "shingles")


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, share: tuple[int, int] = SHARE,
           part: int = PART) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id. share: least intersection over union, as (90, 100)."""
    rows = shingle_sets(docs, key, text, size, share)
    same = ["s1", "s2"]
    classes = written(rows.where("n_shingles > 0").groupBy(*same).agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"),
        *[F.first(c).alias(c) for c in ("tokens", "places", "left", "ordered")])
        .withColumn("vertex", F.monotonically_increasing_id()), "sets")
    sets = classes.where("tokens is not null")
    links = verified_links(sets, components(candidate_links(sets, share)), share, part)
    groups = components(links)
    rooted = classes.select(*same, "least", "vertex").join(groups.withColumnRenamed("a", "vertex"), "vertex", "left").select(
        *same, "least", F.coalesce("b", "vertex").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select(*same, "component_id")
    full = rows.where("n_shingles > 0").select("doc_id", "n_shingles", *same).join(labels, same).select(
        "doc_id", "n_shingles", "component_id")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)
