"""Alignment of two tokenizers' tokens over a corpus: byte-level BPE (A) against pieces with byte fallback (B).

A text is encoded as a space and the text. Byte offsets where a token of A and one of B end cut both into groups; the two
tokens that end there are linked. Pass one aligns all documents and gathers which pairs of ids are linked, with counts per
task. Distinct pairs are dealt into segments by hash; each segment gets a minimal perfect hash, a cascade of bit arrays in
which every pair has a place alone, so the pairs of all segments fill the places 0, 1, 2, ... without gaps. Counts become
dense vectors over these places and are summed as a tree, FAN_IN vectors at a time. Beside each count stands its pair, so a
look-up can tell that it met its own place. Pass two aligns the documents again and looks the counts up.

Both tokenizers cut a text at known places: A's pre-tokenizer and the lack of pieces over these places in B's vocabulary
(checked when it is read) allow to cut between a letter and an ASCII character that is none, and before a space that
follows no white space. So words are encoded once and remembered, up to a limit. A text with other white space before a
space, and one whose tokens do not give its bytes back word by word, is encoded as a whole. Texts that are null, empty or
whose joined bytes differ from space and text have no tokens: zeros, and no groups.

The table of pairs goes to all tasks while it has at most TABLE_PAIRS pairs, whose size is known before; beyond that,
documents' pairs are joined with it. The highest counts per id of B are at most as many as B has ids.

Repeated rows are documents of their own; ids may be null. An empty table gives an empty result. Only the columns named
are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .lm import U64, packed, packed_sorted, ranges_of, unpacked, unpacked_sorted
from .substrings import mixed

REMEMBERED_WORDS = 650_000
REMEMBERED_UNITS = 650_000
CHAIN = 20_000
CHUNK_PAIRS = 4_000_000
SEGMENT_PAIRS = 1 << 16
TABLE_PAIRS = 4_000_000
FAN_IN = 32
OUT_ROWS = 200

# Letters and white space on which all versions of Unicode since 6.3 agree. What is left out is never cut at.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ƿΑ-ΡΣ-ώЀ-ҁ"
WHITE = " \t\n\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‍    　﻿"
CUT = re.compile(f"(?<=[{LETTERS}])(?=[\\x00-@\\[-`{{-\\x7f])|(?<=[^{WHITE}])(?= )")
LETTER, BLANK = re.compile(f"[{LETTERS}]"), re.compile(f"[{WHITE}]")
MARK = " x"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Column:
    """Numbers that are added to; a view taken before stays as it is."""

    def __init__(self, kind=np.int64):
        self.data, self.n = np.zeros(1 << 12, kind), 0

    def add(self, values) -> None:
        values = np.asarray(values, self.data.dtype)
        if self.n + len(values) > len(self.data):
            grown = np.zeros(max(2 * len(self.data), self.n + len(values)), self.data.dtype)
            grown[:self.n] = self.data[:self.n]
            self.data = grown
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)

    def view(self) -> np.ndarray:
        return self.data[:self.n]


class Lists:
    """Lists of numbers, one after the other."""

    def __init__(self):
        self.flat, self.start, self.size = Column(), Column(), Column(np.int32)

    def add(self, flat, sizes) -> None:
        sizes = np.asarray(sizes, np.int64)
        self.start.add(self.flat.n + np.cumsum(sizes) - sizes)
        self.size.add(sizes)
        self.flat.add(flat)

    def of(self, which: np.ndarray) -> np.ndarray:
        """The lists of these numbers, joined."""
        n = self.size.view()[which].astype(np.int64)
        last = np.cumsum(n)
        if not len(n) or not last[-1]:
            return np.zeros(0, np.int64)
        return self.flat.view()[np.arange(int(last[-1])) + np.repeat(self.start.view()[which] - last + n, n)]


class Pair:
    """Both tokenizers, and what is remembered of words.

    A word is a piece between spaces, with the space before it; it consists of units, which both tokenizers treat apart
    from what stands beside them. Of each unit: number of A's and B's tokens, linked id pairs, groups as text.
    """

    held: dict[tuple[str, str], Pair] = {}

    @classmethod
    def of(cls, a: str, b: str) -> Pair:
        """One per worker process, which serves many tasks."""
        if (a, b) not in cls.held:
            cls.held[a, b] = cls(a, b)
        return cls.held[a, b]

    def __init__(self, a: str, b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        entry = [self.a.id_to_token(i) for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode() for t in entry]
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.n_b = n
        self.length_a, self.length_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        self.by_units = not any(CUT.search(p.replace("▁", " ")) for i, p in enumerate(pieces) if not self.b.is_byte(i)
                                and not self.b.is_control(i) and not self.b.is_unknown(i))
        self.generation = 0
        self.forget()

    def forget(self) -> None:
        self.generation += 1
        self.words: dict[str, int] = {}
        self.units: dict[str, int] = {}  # without the space before, or with one if there is none
        self.parts, self.odd = Lists(), Column(bool)  # of words; what follows an odd word may depend on it
        self.groups: list[str] = []  # of units, as are the next
        self.count_a, self.count_b, self.bad, self.keys = Column(np.int32), Column(np.int32), Column(bool), Lists()

    def full(self) -> bool:
        return len(self.words) > REMEMBERED_WORDS or len(self.units) > REMEMBERED_UNITS

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text that starts with a space; B puts that space there itself."""
        return (np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64),
                np.array(self.b.encode(text[1:], num_threads=1), np.int64))

    def true(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        data = text.encode("utf-8", "surrogatepass")
        return (b"".join(map(self.bytes_a.__getitem__, a.tolist())) == data
                and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == data)

    def ends(self, a: np.ndarray, b: np.ndarray):
        """Offsets where both end, and the places of the tokens that end there."""
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        if not len(a):
            return end_a, end_a, end_a
        at = np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)
        at_a = np.flatnonzero(end_b[at] == end_a)
        return end_a[at_a], at_a, at[at_a]

    def whole(self, text: str):
        """(n_a, n_b, groups, linked pairs) of a text taken as a whole; None if its bytes do not come back."""
        a, b = self.encode(text)
        if not self.true(text, a, b):
            return None
        _, at_a, at_b = self.ends(a, b)
        return len(a), len(b), ";".join(self._texts(a, b, at_a, at_b)), a[at_a] * self.n_b + b[at_b]

    @staticmethod
    def _texts(a, b, at_a, at_b) -> list[str]:
        """The groups as text; most have one token of each."""
        out = [f"{x}|{y}" for x, y in zip(a[at_a].tolist(), b[at_b].tolist())]
        first_a, first_b = np.append(0, at_a[:-1] + 1), np.append(0, at_b[:-1] + 1)
        several = np.flatnonzero((first_a < at_a) | (first_b < at_b))
        of_a, of_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        for i, v, x, w, y in zip(several.tolist(), first_a[several].tolist(), (at_a[several] + 1).tolist(),
                                 first_b[several].tolist(), (at_b[several] + 1).tolist()):
            out[i] = f"{','.join(of_a[v:x])}|{','.join(of_b[w:y])}"
        return out

    def _keep(self, units: list[str], n_a, n_b, groups: list[str], keys, n_links, bad: bool = False) -> None:
        self.units.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        self.groups += groups
        self.count_a.add(n_a)
        self.count_b.add(n_b)
        self.keys.add(keys, n_links)
        self.bad.add([bad] * len(units))

    def _chain(self, units: list[str]) -> None:
        """Units in a row, with a mark between two that could be taken together; it can be cut off on both sides."""
        texts, own, before = [MARK], [], "x"
        for key in units:
            unit = key[1:] if key[:1] == " " else " " + key
            if key[:1] == " " and not LETTER.match(before):
                texts.append(MARK)
            own.append(len(texts))
            texts.append(unit)
            before = unit[-1]
        text = "".join(texts)
        a, b = self.encode(text)
        if not self.true(text, a, b):
            if len(units) == 1:
                return self._keep(units, [0], [0], [""], [], [0], True)
            for unit in units:
                self._chain([unit])
            return
        common, at_a, at_b = self.ends(a, b)
        keys = a[at_a] * self.n_b + b[at_b]
        size = [len(t) for t in texts] if text.isascii() else [len(t.encode("utf-8", "surrogatepass")) for t in texts]
        last = np.searchsorted(common, np.cumsum(size))
        number = np.diff(last, prepend=-1)  # groups of each text
        ours = np.zeros(len(texts), bool)
        ours[own] = True
        groups = self._texts(a, b, at_a, at_b)
        joined = [groups[y] if x + 1 == y else ";".join(groups[x + 1:y + 1])
                  for x, y in zip((last - number)[own].tolist(), last[own].tolist())]
        self._keep(units, np.diff(at_a[last], prepend=-1)[own], np.diff(at_b[last], prepend=-1)[own], joined,
                   keys[np.repeat(ours, number)], number[own])

    def learn(self, words: list[str]) -> None:
        cuts = []
        for word in words:
            if word.isalpha():
                cuts.append((word,))
                continue
            first, *rest = CUT.split(" " + word)
            cuts.append((first[1:], *[" " + u for u in rest]))
        new = list({u for units in cuts for u in units}.difference(self.units))
        chain, size = [], 0
        for unit in new:
            if not unit or BLANK.match(unit[-1]) or len(unit) > CHAIN:
                self._chain([unit])
                continue
            chain.append(unit)
            size += len(unit)
            if size > CHAIN:
                self._chain(chain)
                chain, size = [], 0
        if chain:
            self._chain(chain)
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.parts.add([self.units[u] for units in cuts for u in units], [len(units) for units in cuts])
        self.odd.add([not w or BLANK.match(w[-1]) is not None for w in words])

    def units_of(self, texts: list[str]) -> list[np.ndarray | None]:
        """The units of each text, or None where it has to be taken as a whole."""
        split = [t.split(" ") if self.by_units else [] for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        new = new.difference(self.words)  # goes through the new ones alone
        if new:
            self.learn(list(new))
        odd, bad = self.odd.view(), self.bad.view()
        out: list[np.ndarray | None] = []
        for words in split:
            at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            if not len(at) or odd[at[:-1]].any():
                out.append(None)
                continue
            own = self.parts.of(at)
            out.append(None if bad[own].any() else own)
        return out


def _batches(batches: Iterator[pa.RecordBatch], text: int, size: int = 1 << 20):
    """(rows of the batch, texts) of about a megabyte."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        first, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t or "")
            if held > size or i - first + 1 == OUT_ROWS:
                yield batch, first, texts[first:i + 1]
                first, held = i + 1, 0
        if first < len(texts):
            yield batch, first, texts[first:]


# Pass one: which pairs there are --------------------------------------------------------------------------------------

def _gather(a: str, b: str):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of distinct pairs with their counts, usually one a task."""
        pair = Pair.of(a, b)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        uses, generation = np.zeros(0, np.int64), pair.generation

        def add(more: np.ndarray, times: np.ndarray) -> None:
            nonlocal keys, counts
            keys, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([counts, times]), minlength=len(keys)).astype(np.int64)

        def settle() -> None:
            nonlocal uses
            used = np.flatnonzero(uses)
            add(pair.keys.of(used), np.repeat(uses[used], pair.keys.size.view()[used]))
            uses = np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([len(keys)], pa.int64()), pa.array([packed_sorted(keys.astype(U64))], pa.binary()),
                pa.array([packed(counts)], pa.binary())], names=["n", "keys", "counts"])

        for _, _, texts in _batches(batches, 0):
            if pair.full():
                settle()
                pair.forget()
            texts = [t for t in texts if t]
            found = pair.units_of(texts)
            new = np.bincount(np.concatenate([np.zeros(0, np.int64), *(u for u in found if u is not None)]), minlength=len(pair.groups))
            new[:len(uses)] += uses
            uses = new
            for text, units in zip(texts, found):
                if units is None and (whole := pair.whole(" " + text)):
                    add(*np.unique(whole[3], return_counts=True))
            if len(keys) > CHUNK_PAIRS:
                yield out()
                keys, counts = keys[:0], counts[:0]
        settle()
        if len(keys):
            yield out()

    return gather


# Minimal perfect hash -------------------------------------------------------------------------------------------------

def _place(hashes: np.ndarray, level: int, size) -> np.ndarray:
    return (mixed(hashes + U64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % size).astype(np.int64)


def perfect(keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Sizes of the cascade's bit arrays, their bits, and the keys in the order of their places."""
    left, sizes, bits, ordered = keys, [], [], []
    while len(left):
        size = -(-2 * len(left) // 64) * 64
        place = _place(mixed(left), len(sizes), U64(size))
        alone = np.bincount(place, minlength=size)[place] == 1
        own = np.zeros(size, bool)
        own[place[alone]] = True
        ordered.append(left[alone][np.argsort(place[alone])])
        sizes.append(size)
        bits.append(np.packbits(own, bitorder="little").tobytes())
        left = left[~alone]
    return sizes, b"".join(bits), np.concatenate([np.zeros(0, U64), *ordered])


@dataclass
class Places:
    """The cascades of segments: looks up the places of pairs."""

    bits: int
    sizes: np.ndarray  # segments x levels
    offsets: np.ndarray
    words: np.ndarray
    before: np.ndarray  # set bits before each word
    keys: np.ndarray

    @classmethod
    def of(cls, bits: int, segments: list[int], sizes: list[list[int]], data: list[bytes], keys: list[np.ndarray]) -> Places:
        levels = max(map(len, sizes), default=0)
        table = np.zeros((1 << bits, levels), np.int64)
        offsets = np.zeros((1 << bits, levels), np.int64)
        total = 0
        for segment, own in zip(segments, sizes):
            table[segment, :len(own)] = own
            offsets[segment, :len(own)] = total + np.cumsum(own) - own
            total += sum(own)
        words = np.frombuffer(b"".join(data), "<u8")
        ones = np.bitwise_count(words).astype(np.int64)
        return cls(bits, table, offsets, words, np.cumsum(ones) - ones, np.concatenate([np.zeros(0, U64), *keys]))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 of one that the table does not have."""
        hashes = mixed(keys)
        segment, out = ranges_of(hashes, self.bits), np.full(len(keys), -1)
        todo = np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            todo = todo[self.sizes[segment[todo], level] > 0]
            if not len(todo):
                break
            own = segment[todo]
            at = self.offsets[own, level] + _place(hashes[todo], level, self.sizes[own, level].astype(U64))
            word, bit = at >> 6, (at & 63).astype(U64)
            hit = (self.words[word] >> bit & U64(1)).astype(bool)
            below = self.words[word[hit]] & ((U64(1) << bit[hit]) - U64(1))
            out[todo[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            todo = todo[~hit]
        met = np.flatnonzero(out >= 0)
        out[met[self.keys[out[met]] != keys[met]]] = -1
        return out


def _segments(bits: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                keys, counts = unpacked_sorted(keys), unpacked(counts, "<i8")
                own = ranges_of(mixed(keys), bits)
                order = np.argsort(own, kind="stable")
                cuts = np.flatnonzero(np.diff(own[order], prepend=-1))
                rows = [(int(own[at[0]]), chunk, packed_sorted(keys[at]), packed(counts[at])) for at in np.split(order, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["segment", "chunk", "keys", "counts"])

    return cut


def _build(rows: pa.Table) -> pa.Table:
    """A segment's cascade and its keys."""
    keys = np.unique(np.concatenate([unpacked_sorted(k) for k in rows.column("keys").to_pylist()]))
    sizes, bits, ordered = perfect(keys)
    return pa.table({"segment": [rows.column("segment")[0].as_py()], "sizes": [sizes], "bits": [bits], "keys": [packed(ordered)]})


def _dense(rows: pa.Table, cascade: pa.Table) -> pa.Table:
    """The counts of some chunks as one vector over the places of their segment."""
    if not rows.num_rows:
        return pa.table({"segment": pa.array([], pa.int64()), "fan": pa.array([], pa.int64()), "vector": pa.array([], pa.binary())})
    sizes, bits, keys = (cascade.column(c)[0].as_py() for c in ("sizes", "bits", "keys"))
    places = Places.of(0, [0], [sizes], [bits], [unpacked(keys, "<u8")])
    vector = np.zeros(len(places.keys), np.int64)
    for own, counts in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist()):
        vector[places.find(unpacked_sorted(own))] += unpacked(counts, "<i8")  # all are there
    return pa.table({"segment": rows.column("segment")[:1], "fan": rows.column("fan")[:1], "vector": [packed(vector)]})


def _sum(rows: pa.Table) -> pa.Table:
    total = np.sum([unpacked(v, "<i8") for v in rows.column("vector").to_pylist()], axis=0)
    return pa.table({"segment": rows.column("segment")[:1], "fan": pa.array([rows.column("fan")[0].as_py() // FAN_IN], pa.int64()),
                     "vector": [packed(total)]})


def counted(docs: DataFrame, a: str, b: str, text: str = "text") -> tuple[DataFrame, int, int]:
    """Segments of all linked pairs: segment, sizes, bits, keys (in order of their places), vector (their counts); the
    number of bits of a segment's number; at most how many pairs there are."""
    chunks = written(docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        _gather(a, b), "n long, keys binary, counts binary").withColumn("chunk", F.monotonically_increasing_id()), "pairs")
    most, n = chunks.agg(F.sum("n"), F.count(F.lit(1))).first()
    bits = max(0, (max(1, -(-(most or 0) // SEGMENT_PAIRS)) - 1).bit_length())
    fans = max(1, -(-n // FAN_IN))
    cut = chunks.select("chunk", "keys", "counts").mapInArrow(_segments(bits), "segment long, chunk long, keys binary, counts binary")
    cascades = written(cut.groupBy("segment").applyInArrow(_build, "segment long, sizes array<long>, bits binary, keys binary"), "places")
    dealt = cut.withColumn("fan", F.pmod(F.xxhash64("chunk"), F.lit(fans)))
    every = cascades.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(fans - 1).cast("long"))).alias("fan"))
    vectors = dealt.groupBy("segment", "fan").cogroup(every.groupBy("segment", "fan")).applyInArrow(
        _dense, "segment long, fan long, vector binary")
    while fans > 1:
        vectors = vectors.groupBy("segment", F.floor(F.col("fan") / FAN_IN).alias("_fan")).applyInArrow(
            _sum, "segment long, fan long, vector binary")
        fans = -(-fans // FAN_IN)
    return written(cascades.join(vectors.drop("fan"), "segment"), "counts"), bits, most or 0


def _pairs(n_b: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, vector in zip(*(c.to_pylist() for c in batch.columns)):
                keys = unpacked(keys, "<u8").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys // n_b), pa.array(keys % n_b), pa.array(unpacked(vector, "<i8"))],
                                                 names=["a", "b", "count"])

    return rows


def pairs(segments: DataFrame, n_b: int) -> DataFrame:
    """(a, b, count): every pair of ids that is linked somewhere, and how often."""
    return segments.select("keys", "vector").mapInArrow(_pairs(n_b), "a long, b long, count long")


# Pass two: documents --------------------------------------------------------------------------------------------------

class Counts:
    """What one link of each pair adds: its count, and whether no pair has more with the same id of B."""

    def __init__(self, places: Places, counts: np.ndarray, best: np.ndarray, n_b: int):
        self.places, self.counts, self.n_b = places, counts, n_b
        self.best = counts == best[(places.keys % U64(n_b)).astype(np.int64)]
        self.generation, self.units = -1, (np.zeros(0, np.int64),) * 3

    def _of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, whether it is the highest, and whether the pair is missing."""
        at = self.places.find(keys.astype(U64))
        none = at < 0
        if not len(self.counts):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), none.astype(np.int64)
        return np.where(none, 0, self.counts[at]), (~none & self.best[at]).astype(np.int64), none.astype(np.int64)

    def of_units(self, pair: Pair) -> tuple[np.ndarray, ...]:
        """The sums over each unit's links. Units remembered from other texts may have pairs that the table does not."""
        if pair.generation != self.generation:
            self.generation, self.units = pair.generation, (np.zeros(0, np.int64),) * 3
        new = np.arange(len(self.units[0]), len(pair.groups))
        if len(new):
            ends = np.append(0, np.cumsum(pair.keys.size.view()[new], dtype=np.int64))
            found = self._of(pair.keys.of(new))
            sums = (np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for x in found)
            self.units = tuple(np.concatenate([old, more]) for old, more in zip(self.units, sums))
        return self.units

    @staticmethod
    def summed(each: tuple[np.ndarray, ...]) -> tuple[int, int]:
        total, best, missing = (int(x.sum()) for x in each)
        if missing:
            raise ValueError("a pair of pass two was not met in pass one: the input changed between them")
        return total, best

    def of_links(self, keys: np.ndarray) -> tuple[int, int]:
        return self.summed(self._of(keys))


DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, keys binary"


def _align(a: str, b: str, read):
    """read() gives the Counts, or None where the pairs of each document are to be joined with theirs."""
    schema = pa.schema([*((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                        ("groups", pa.string()), ("keys", pa.binary())])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, counts = Pair.of(a, b), read()
        for batch, first, texts in _batches(batches, 1):
            if pair.full():
                pair.forget()
            rows = []
            found = pair.units_of([t or "" for t in texts])
            n_a, n_b, links = pair.count_a.view(), pair.count_b.view(), pair.keys.size.view()
            added = counts.of_units(pair) if counts else None
            for doc_id, text, units in zip(batch.column(0).slice(first, len(texts)).to_pylist(), texts, found):
                if not text:
                    rows.append((doc_id, 0, 0, 0, 0, 0, 0, "", None))
                elif units is not None:
                    n, of_doc = int(links[units].sum(dtype=np.int64)), units.tolist()
                    total, best = counts.summed(tuple(x[units] for x in added)) if counts else (0, 0)
                    keys = None if counts else pair.keys.of(units).astype("<i8").tobytes()
                    rows.append((doc_id, int(n_a[units].sum(dtype=np.int64)), int(n_b[units].sum(dtype=np.int64)), n, n, best, total,
                                 ";".join([pair.groups[i] for i in of_doc]), keys))
                elif (whole := pair.whole(" " + text)) is None:
                    rows.append((doc_id, 0, 0, 0, 0, 0, 0, "", None))
                else:
                    n, (total, best) = len(whole[3]), counts.of_links(whole[3]) if counts else (0, 0)
                    rows.append((doc_id, *whole[:2], n, n, best, total, whole[2],
                                 None if counts else whole[3].astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return align


def _each_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, key, times): the distinct pairs of each document."""
    for batch in batches:
        for row, keys in zip(*(c.to_pylist() for c in batch.columns)):
            distinct, times = np.unique(np.frombuffer(keys, "<i8"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), row)), pa.array(distinct), pa.array(times)],
                                             names=["row", "key", "times"])


def align(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", table_pairs: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (as `a1,a2|b1;a3|b2,b3`).

    a: path of a byte-level BPE of the tokenizers library, b: of a sentencepiece model; both are read where tasks run.
    """
    spark = docs.sparkSession
    n_b = Pair.of(a, b).n_b
    segments, bits, most = counted(docs, a, b, text)
    best = pairs(segments, n_b).groupBy("b").agg(F.max("count").alias("best"))
    thin = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    limit = TABLE_PAIRS if table_pairs is None else table_pairs
    n = segments.agg(F.sum(F.octet_length("vector").cast("long"))).first()[0] or 0  # most counts pairs once per chunk
    if n // 8 <= limit:
        rows = segments.collect()  # at most `limit` pairs
        highest = np.zeros(n_b, np.int64)
        for r in best.collect():  # at most an entry per id of B
            highest[r.b] = r.best
        places = Places.of(bits, [r.segment for r in rows], [r.sizes for r in rows], [bytes(r.bits) for r in rows],
                           [unpacked(bytes(r["keys"]), "<u8") for r in rows])
        vector = np.concatenate([np.zeros(0, np.int64), *(unpacked(bytes(r.vector), "<i8") for r in rows)])
        shared = spark.sparkContext.broadcast((places, vector, highest))
        return thin.mapInArrow(_align(a, b, lambda: Counts(*shared.value, n_b)), DOC).select(*columns)
    found = written(thin.mapInArrow(_align(a, b, lambda: None), DOC).withColumn("row", F.monotonically_increasing_id()), "aligned")
    known = pairs(segments, n_b).join(best, "b").select(
        (F.col("a") * n_b + F.col("b")).alias("key"), "count", (F.col("count") == F.col("best")).cast("long").alias("top"))
    each = found.where("keys is not null").select("row", "keys").mapInArrow(_each_pair, "row long, key long, times long").join(known, "key")
    sums = each.groupBy("row").agg(F.sum(F.col("times") * F.col("top")).alias("_best"), F.sum(F.col("times") * F.col("count")).alias("_sum"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").withColumns(
        {"n_best": F.coalesce("_best", zero), "count_sum": F.coalesce("_sum", zero)}).select(*columns)
