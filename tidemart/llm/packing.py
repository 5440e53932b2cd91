"""Packing of tokenized documents into windows, online and in bounded space.

Each task keeps a fixed number of open windows. A document's full windows leave at once; its rest goes into the open
window that it fills best; where it fits into none and no more may be opened, the fullest is emitted. What is open at
the end of a task is a leftover. Leftovers of up to 64 tasks meet and are packed again, longest piece first, in rounds,
until one group is left; its last windows are joined by cutting, so that only one sequence of all is padded for want of
text. A group never holds more than 64 x open windows, whatever the size of the input.

A null or empty text is the end id alone. Repeated rows are documents of their own. An empty table gives no pieces.
Round 0 is written once, closed and open windows together: a task that runs again cannot pack differently in one of both.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs, written

WINDOW = 4096
OPEN_WINDOWS = 64
FAN_IN = 64
END_ID = 2
MEMORY = 120 << 20  # bytes a worker remembers words by, a third of them for whole words
ENTRY_BYTES = 170  # of a dictionary's entry and its two objects
LINE = 1000
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")  # ASCII and Latin-1 letters in UTF-8
LONG = 1 << 20
TEXTS = 500
TAIL = b".,!?;:*#%$&"
BATCH_ROWS = 20_000

SCHEMA = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "part long, ids binary")


class WordIds:
    """Ids of texts by a tokenizer that drops white space, lower-cases, and cuts between letters and punctuation.

    Such a tokenizer never joins across white space, so each word is encoded once and remembered; a word that ends in
    a letter or digit and common punctuation is put together from the two, and an ASCII one is lower-cased first.
    The memory is bounded by its bytes: a full one starts anew.
    """

    held: dict[tuple[str, int], WordIds] = {}

    @classmethod
    def shared(cls, path: str, memory: int) -> WordIds:
        """One per worker process, which serves many tasks."""
        if (path, memory) not in cls.held:
            cls.held.clear()
            cls.held[path, memory] = cls(path, memory)
        return cls.held[path, memory]

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = "<|startoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.ends_word = np.array([t.endswith("</w>") for t in entries])
        self.words: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {b"": b""}
        self.word_bytes = self.stem_bytes = 0
        self.most_words, self.most_stems = memory // 3, memory - memory // 3

    def _keep_ends(self, stems: list[bytes], ids: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> None:
        data = ids.tobytes()
        self.stems.update(zip(stems, [data[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]))

    def _encode_letters(self, stems: list[bytes]) -> list[bytes]:
        """Stems of letters are one word each to the tokenizer, so the ends of words in a line of them are theirs. Gives back
        those that have to be encoded otherwise."""
        texts = [s.decode() for s in stems]
        lines = [texts[i:i + LINE] for i in range(0, len(texts), LINE)]
        rest = []
        for i, found in enumerate(self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            ends, own = np.flatnonzero(self.ends_word[ids]) + 1, stems[i * LINE:(i + 1) * LINE]
            if len(ends) != len(own):
                rest += own
                continue
            self._keep_ends(own, ids, ends, np.append(0, ends[:-1]))
        return rest

    def _encode(self, stems: list[bytes]) -> None:
        """Other stems go into one call with a special token between them that shows where each one ends."""
        letters, others = [], []
        for stem in stems:
            (letters if LETTERS.fullmatch(stem) else others).append(stem)
        stems = others + self._encode_letters(letters)
        plain = [s for s in stems if b"<|" not in s]
        groups = [plain[i:i + 50] for i in range(0, len(plain), 50)]
        texts = [self.mark.join([s.decode("utf-8", "replace") for s in group]) for group in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
            self._keep_ends(group, ids, ends, np.append(0, ends[:-1] + 1))
        for stem in stems:
            if b"<|" in stem:
                ids = self.tokenizer.encode(stem.decode("utf-8", "replace"), add_special_tokens=False).ids
                self.stems[stem] = np.array(ids, dtype="<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Remember the ids of words not known yet."""
        plain = [w for w in words if w[-1] not in TAIL]
        tailed = [w for w in words if w[-1] in TAIL]
        cut = [w.rstrip(TAIL) for w in tailed]
        cut = [stem if stem[-1:].isalnum() else w for w, stem in zip(tailed, cut)]
        tails = [w[len(stem):] for w, stem in zip(tailed, cut)]
        # The tokenizer lower-cases after composing characters, so this may come first in ASCII alone. It makes fewer stems.
        plain_stems, cut = ([w.lower() if w.isascii() else w for w in x] for x in (plain, cut))
        if self.stem_bytes > self.most_stems:
            self.stems, self.stem_bytes = {b"": b""}, 0
        new = list({*plain_stems, *cut, *tails}.difference(self.stems))
        self._encode(new)
        of = self.stems.__getitem__
        self.words.update(zip(plain, map(of, plain_stems)))
        self.words.update(zip(tailed, [of(stem) + of(tail) for stem, tail in zip(cut, tails)]))
        self.stem_bytes += ENTRY_BYTES * len(new) + 3 * sum(map(len, new))
        self.word_bytes += ENTRY_BYTES * len(words) + 2 * sum(map(len, words))

    def of_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of some texts, as bytes; each text is split once, a very long one slab by slab."""
        split = [t.split() if len(t) < LONG else [] for t in texts]
        new: set[bytes] = set()
        for words in split:
            new.update(words)
        if self.word_bytes > self.most_words:
            self.words, self.word_bytes = {}, 0
        new = new.difference(self.words)
        if new:
            self.learn(new)
        of = self.words.__getitem__
        out = [b"".join(map(of, words)) for words in split]
        for i, text in enumerate(texts):
            if len(text) >= LONG:
                out[i] = b"".join([self.of_slab(slab) for slab in slabs(text, LONG // 2)])
        return out

    def of_slab(self, slab: bytes) -> bytes:
        words = slab.split()
        self.learn(set(words).difference(self.words))
        return b"".join(map(self.words.__getitem__, words))


class Packer:
    """Open windows sorted by fill; a window is a list of (piece, length)."""

    def __init__(self, window: int, most_open: int):
        self.window, self.most_open = window, most_open
        self.fills: list[int] = []
        self.windows: list[list] = []

    def put(self, piece, length: int) -> list | None:
        """Place a piece; gives back the pieces of a window that closed, if one did."""
        closed = None
        at = bisect.bisect_right(self.fills, self.window - length) - 1  # the fullest that still has room
        if at >= 0:
            fill, pieces = self.fills.pop(at) + length, self.windows.pop(at)
            pieces.append((piece, length))
        else:
            if len(self.fills) >= self.most_open:
                self.fills.pop()
                closed = self.windows.pop()
            fill, pieces = length, [(piece, length)]
        if fill == self.window:
            return pieces  # only an open window gets full: a piece is shorter than a window
        at = bisect.bisect_left(self.fills, fill)
        self.fills.insert(at, fill)
        self.windows.insert(at, pieces)
        return closed


class Rows:
    """Collects output rows and cuts them into batches."""

    def __init__(self, schema: pa.Schema, base: int):
        self.schema, self.base, self.sequences = schema, base, 0
        self.rows: list[tuple] = []

    def sequence(self, pieces: list, part: int | None = None) -> None:
        offset, number = 0, self.base + self.sequences
        self.sequences += 1
        for (doc_id, start, doc_tokens, ids), length in pieces:
            self.rows.append((doc_id, start, length, zlib.crc32(ids), doc_tokens, number, offset, part,
                              None if part is None else ids))
            offset += length

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[] for _ in self.schema]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def out_schema(id_type: pa.DataType) -> pa.Schema:
    long = pa.int64()
    return pa.schema([("doc_id", id_type), ("start", long), ("length", long), ("ids_crc32", long), ("doc_tokens", long),
                      ("sequence_id", long), ("offset", long), ("part", long), ("ids", pa.binary())])


def sequence_base(round_: int, part: int) -> int:
    return round_ << 58 | part << 32


def pack_part(batches: Iterator[pa.RecordBatch], path: str, window: int, most_open: int, end_id: int, memory: int = MEMORY):
    words, packer, part = WordIds.shared(path, memory), Packer(window, most_open), TaskContext.get().partitionId()
    end, out = np.array([end_id], dtype="<u4").tobytes(), None
    for batch in batches:
        if out is None:
            out = Rows(out_schema(batch.schema.field(0).type), sequence_base(0, part))
        ids_of, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
        for first in range(0, len(texts), TEXTS):
            some = words.of_all([t or b"" for t in texts[first:first + TEXTS]])
            for doc_id, ids in zip(ids_of[first:first + TEXTS], some):
                ids += end
                total = len(ids) // 4
                for start in range(0, total - total % window, window):
                    out.sequence([((doc_id, start, total, ids[4 * start:4 * (start + window)]), window)])
                rest = total % window
                if rest:
                    closed = packer.put((doc_id, total - rest, total, ids[4 * (total - rest):]), rest)
                    if closed:
                        out.sequence(closed)
            if len(out.rows) > BATCH_ROWS:
                yield out.batch()
    if out is not None:
        for pieces in packer.windows:
            out.sequence(pieces, part)
        yield out.batch()


def merge_parts(key, rows: pa.Table, round_: int, last: bool, window: int, most_open: int) -> pa.Table:
    group = key[0].as_py()
    out = Rows(out_schema(rows.schema.field("doc_id").type), sequence_base(round_, group))
    names = ("doc_id", "start", "doc_tokens", "ids", "length")
    pieces = list(zip(*(rows.column(n).to_pylist() for n in names)))
    pieces.sort(key=lambda p: (-p[4], p[0] is None, p[0], p[1], p[3]))
    packer = Packer(window, most_open)
    for doc_id, start, total, ids, length in pieces:
        closed = packer.put((doc_id, start, total, ids), length)
        if closed:
            out.sequence(closed)
    if not last:
        for pieces in packer.windows:
            out.sequence(pieces, group)
    else:  # cut to fill
        room, current = window, []
        for (doc_id, start, total, ids), length in (p for pieces in reversed(packer.windows) for p in pieces):
            while length:
                take = min(room, length)
                current.append(((doc_id, start, total, ids[:4 * take]), take))
                ids, start, length, room = ids[4 * take:], start + take, length - take, room - take
                if not room:
                    out.sequence(current)
                    room, current = window, []
        if current:
            out.sequence(current)
    return pa.Table.from_batches([out.batch()])


def merger(round_: int, last: bool, window: int, most_open: int):
    def merge(key, rows):
        return merge_parts(key, rows, round_, last, window, most_open)

    return merge


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         most_open: int = OPEN_WINDOWS, end_id: int = END_ID, memory: int = MEMORY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. memory: of a worker, for words."""
    thin = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = SCHEMA.format(id=thin.schema[0].dataType.simpleString())
    closed: list[DataFrame] = []
    rows = written(thin.mapInArrow(
        lambda batches: pack_part(batches, tokenizer, window, most_open, end_id, memory), schema), "packed")
    round_ = 0
    while True:
        closed.append(rows.where(F.col("part").isNull()))
        left = rows.where(F.col("part").isNotNull())
        highest = left.agg(F.max("part")).first()[0]
        if highest is None:
            break
        round_, last = round_ + 1, highest < FAN_IN
        rows = written(left.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(
            merger(round_, last, window, most_open), schema), "packed")
    pieces = closed[0]
    for more in closed[1:]:
        pieces = pieces.unionByName(more)
    return pieces.drop("part", "ids")
