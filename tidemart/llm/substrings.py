"""Substring dedup by level-wise doubling.

Level one looks at windows of half the length, and of these only at anchors: the window of least hash among any run of
consecutive ones that a full window holds, so every full window holds an anchor, and equal windows hold the same. Anchors
that occur in two documents survive. Level two extends: full windows around surviving anchors, twice as long, are looked
up in turn; those that start in a document with a smaller id cover their words. At the full length the answer is final,
so no candidate is left to be extended.

Documents are dealt into blocks. On each level a block asks for its distinct window hashes by hash range, with the
smallest and largest of its ids that have them; the ranges answer with what the blocks need to know. A window goes through
the shuffle once per block and level, however many copies there are. Texts go through once: all three uses of a block
read the same exchange.

Windows are judged on the input. Null ids count as larger than all others, equal ids as one document. A null text has no
words; a text shorter than the window loses none. Empty tables give empty results. Only the columns named are read.
Windows are compared by 64-bit hashes of their words: among 10^9 windows a false match has a chance of about 3 %.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .lm import U64, Vocabulary, packed, packed_sorted, ranges_of, unpacked, unpacked_sorted

WINDOW = 50
BLOCK_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
NO_ID = np.iinfo(np.int64).max


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base), U64)
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


class Block:
    """Words of all documents of a block, one after the other, and hashes of their windows."""

    def __init__(self, rows: pa.Table):
        vocabulary = Vocabulary()
        self.words = [t.split() for t in rows.column("text").cast(pa.binary()).to_pylist()]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.lengths)
        number = np.fromiter((vocabulary[w] for own in self.words for w in own), np.int64, int(self.lengths.sum()))
        self.ids = np.array([NO_ID if i is None else i for i in rows.column("doc_id").to_pylist()], np.int64)
        self.doc = np.repeat(np.arange(len(self.words)), self.lengths)
        n = len(number)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(vocabulary.hashes()[number] * powers(BASE, n), dtype=U64, out=self.sums[1:])
        self.inverse = powers(INVERSE, n + 1)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window that starts at each position, and whether it lies in one document."""
        n = len(self.doc)
        if n < size:
            return np.zeros(0, U64), np.zeros(0, bool)
        start = np.arange(n - size + 1)
        hashes = mixed((self.sums[size:] - self.sums[:-size]) * self.inverse[:n - size + 1])
        return hashes, start + size <= self.ends[self.doc[:n - size + 1]]

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes at half the length, and for each full window (position) its anchor's position or -1."""
        half = window // 2
        hashes, _ = self.windows(half)
        inside = self.windows(window)[1]
        if not len(inside):
            return hashes, np.zeros(0, np.int64)
        width, least = window - half + 1, np.arange(len(hashes))  # leftmost of equal ones
        span = 1
        while 2 * span <= width:
            least = _lesser(hashes, least[:-span], least[span:])
            span *= 2
        if span < width:
            least = _lesser(hashes, least[:len(least) - (width - span)], least[width - span:])
        return hashes, np.where(inside, least[:len(inside)], -1)


def _lesser(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.where(hashes[right] < hashes[left], right, left)


def asked(hashes: np.ndarray, ids: np.ndarray, bits: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """(range, hashes, smallest ids, what the largest ids lie above them) of the distinct hashes."""
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(hashes)) - 1
    hashes, low, high = hashes[first], ids[first], ids[last] if len(first) else ids
    own = ranges_of(hashes, bits)
    cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    return [(int(own[a]), packed_sorted(hashes[a:b]), packed(low[a:b]), packed(high[a:b] - low[a:b]))
            for a, b in zip(cuts, np.append(cuts[1:], len(own)))]


ASK = "block long, range long, hashes binary, low binary, above binary"


def _ask_table(block: int, rows: list) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], [], []]
    types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array([block] * len(rows), pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))],
                    names=["block", "range", "hashes", "low", "above"])


def _ask_anchors(window: int, bits: int):
    def ask(rows: pa.Table) -> pa.Table:
        found = Block(rows)
        hashes, anchor = found.anchors(window)
        at = np.unique(anchor[anchor >= 0])
        return _ask_table(rows.column("block")[0].as_py(), asked(hashes[at], found.ids[found.doc[at]], bits))

    return ask


def _combined(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    hashes = [unpacked_sorted(h) for h in rows.column("hashes").to_pylist()]
    lows = [unpacked(x, "<i8") for x in rows.column("low").to_pylist()]
    highs = [x + unpacked(a, "<i8") for x, a in zip(lows, rows.column("above").to_pylist())]
    low = np.concatenate(lows)
    distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
    least, most = np.full(len(distinct), NO_ID), np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(least, place, low)
    np.maximum.at(most, place, np.concatenate(highs))
    return hashes, highs, least, most, place


def _answer_anchors(rows: pa.Table) -> pa.Table:
    """Per block the anchors that two documents have."""
    hashes, _, least, most, place = _combined(rows)
    shared = np.split((least < most)[place], np.cumsum([len(h) for h in hashes])[:-1])
    return pa.table([rows.column("block"), pa.array([packed_sorted(h[s]) for h, s in zip(hashes, shared)], pa.binary())],
                    names=["block", "hashes"])


def _ask_windows(window: int, bits: int):
    def ask(rows: pa.Table, shared: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _ask_table(0, [])
        found = Block(rows)
        hashes, anchor = found.anchors(window)
        known = np.sort(_joined(shared, "hashes", unpacked_sorted, U64))
        survives = np.append(contained(hashes, known), False)
        at = np.flatnonzero(survives[anchor])
        full, _ = found.windows(window)
        return _ask_table(rows.column("block")[0].as_py(), asked(full[at], found.ids[found.doc[at]], bits))

    return ask


def _joined(rows: pa.Table, column: str, read, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *map(read, rows.column(column).to_pylist())])


def contained(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[place] == values


def _answer_windows(rows: pa.Table) -> pa.Table:
    """Per block the windows that start in a document with a smaller id than one of the block's own."""
    hashes, highs, least, _, place = _combined(rows)
    low = np.split(least[place], np.cumsum([len(h) for h in hashes])[:-1])
    return pa.table([rows.column("block"),
                     pa.array([packed_sorted(h[a < b]) for h, a, b in zip(hashes, low, highs)], pa.binary()),
                     pa.array([packed(a[a < b]) for a, b in zip(low, highs)], pa.binary())],
                    names=["block", "hashes", "low"])


def _remove(window: int):
    def remove(rows: pa.Table, known: pa.Table) -> pa.Table:
        found = Block(rows)
        covered = np.zeros(len(found.doc) + 1, np.int64)
        hashes, inside = found.windows(window)
        have = _joined(known, "hashes", unpacked_sorted, U64)
        low = _joined(known, "low", lambda data: unpacked(data, "<i8"), np.int64)
        if len(have) and len(hashes):
            order = np.argsort(have)
            have, low = have[order], low[order]
            place = np.minimum(np.searchsorted(have, hashes), len(have) - 1)
            hit = np.flatnonzero(inside & (have[place] == hashes) & (low[place] < found.ids[found.doc[:len(hashes)]]))
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + window, -1)
        gone = np.cumsum(covered[:-1]) > 0
        starts, removed, spans, kept = found.ends - found.lengths, [], [], []
        for words, a, b in zip(found.words, starts.tolist(), found.ends.tolist()):
            own = gone[a:b]
            n = int(own.sum())
            removed.append(n)
            spans.append(runs(own) if n else [])
            kept.append(b" ".join([w for w, out in zip(words, own.tolist()) if not out] if n else words))
        return pa.table([rows.column("doc_id"), pa.array(found.lengths), pa.array(removed, pa.int64()),
                         pa.array(spans, SPANS), pa.array(kept, pa.binary()).cast(pa.string())],
                        names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return remove


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def runs(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (spans of word numbers), kept (words joined by a space)."""
    thin = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    size = thin.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    bits = (blocks - 1).bit_length()
    dealt = thin.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(blocks, "block")
    shared = (dealt.groupBy("block").applyInArrow(_ask_anchors(window, bits), ASK)
              .groupBy("range").applyInArrow(_answer_anchors, "block long, hashes binary"))
    known = (dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_ask_windows(window, bits), ASK)
             .groupBy("range").applyInArrow(_answer_windows, "block long, hashes binary, low binary"))
    return dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _remove(window), "doc_id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept string")
