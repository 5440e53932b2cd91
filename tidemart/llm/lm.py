"""Language-model scores by a weighted backoff automaton over word bigrams.

Model. p1(v) = c(v) / (N + n1 + 1) for training tokens, and (n1 + 1) / (N + n1 + 1) for the one unknown token (N tokens,
n1 of them seen once). In a context u seen c(u) times, p(v|u) = (1 - w) c(uv) / c(u) + w p1(v), with the weight
w = 1 / (1 + c(u)^(1 - BETA)). Both sum to one. As an automaton: a state for each context, arcs for its seen bigrams,
and a failure arc of weight w to the empty context, which has an arc for every word. A document is read once from left
to right: the state is carried, failure arcs are followed until an arc fits, log-probabilities are added up.

Scale. The automaton of a whole corpus fits nowhere, so each block of documents gets the part that its texts can reach.
A block asks for its distinct words and bigrams (64-bit hashes, sorted, with its own training counts) by hash range; the
ranges add up the blocks' counts and answer with the totals in the same order; the block builds its automaton and reads
its documents. A word or bigram goes through the shuffle once per block, whatever its frequency. Texts go through once:
both uses of a block read the same exchange. Number of blocks and ranges grow with the input; the driver sees three sums.

Null texts are empty: the end token alone. Words of equal 64-bit hash would be counted as one (at 10^9 distinct words
0.03 such pairs are to be expected). Repeated rows are documents of their own; an empty table gives an empty result. Only the
columns named are read. Without training documents every token is unknown and has probability one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

BLOCK_BYTES = 4 << 20
BETA = 0.9
FLUSH_WORDS = 300_000
U64 = np.uint64
END, START = b" end", b" start"  # no word has a space
MIX = (U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53), U64(0x9E3779B97F4A7C15))


class Vocabulary(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def hashes(self) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(w) for w in self), U64, len(self))


def numbers(text: bytes, vocabulary: Vocabulary) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (left * MIX[2]) ^ (right + MIX[0])
    for m in MIX[:2]:
        h = (h ^ (h >> U64(33))) * m
    return h ^ (h >> U64(33))


def ranges_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def packed(values: np.ndarray) -> bytes:
    """Byte planes: the high bytes of small numbers stand together, where the shuffle's compression removes them."""
    kind = values.dtype.newbyteorder("<")
    return values.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def packed_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes by their distances, which have fewer bytes."""
    return packed(np.diff(hashes, prepend=U64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8"), dtype=U64)


def cut_by_range(hashes: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Sorted hashes and their counts, range by range."""
    own = ranges_of(hashes, bits)
    starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    for a, b in zip(starts, np.append(starts[1:], len(own))):
        yield int(own[a]), packed_sorted(hashes[a:b]), packed(counts[a:b].astype("<u4"))


def added(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, their summed counts, and for each input its place among them."""
    distinct, place = np.unique(hashes, return_inverse=True)
    return distinct, np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64), place


def _counts(rows: pa.Table) -> np.ndarray:
    return np.concatenate([unpacked(c, "<u4") for c in rows.column("counts").to_pylist()])


# Unigram statistics ---------------------------------------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    vocabulary, counts = Vocabulary(), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        hashes = vocabulary.hashes()
        order = np.argsort(hashes)
        rows = list(zip(*cut_by_range(hashes[order], counts[order], bits)))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows or [(), (), ()], (pa.int64(), pa.binary(), pa.binary()))],
            names=["range", "hashes", "counts"])

    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        for i in range(0, len(texts), 200):
            some = texts[i:i + 200]
            found = np.concatenate([numbers(t, vocabulary) for t in some] + [np.zeros(0, np.int64)])
            end = vocabulary[END]
            new = np.bincount(found, minlength=len(vocabulary))
            new[end] += len(some)
            new[:len(counts)] += counts
            counts = new
            if len(vocabulary) > FLUSH_WORDS:
                yield out()
                vocabulary, counts = Vocabulary(), np.zeros(0, np.int64)
    if len(vocabulary):
        yield out()


def _range_sums(rows: pa.Table) -> pa.Table:
    _, total, _ = added(np.concatenate([unpacked_sorted(h) for h in rows.column("hashes").to_pylist()]), _counts(rows))
    return pa.table({"tokens": [int(total.sum())], "words": [len(total)], "once": [int((total == 1).sum())]})


def unigram_sums(texts: DataFrame, bits: int) -> tuple[int, int, int]:
    """N, V, n1 of the training texts."""
    found = texts.mapInArrow(lambda batches: _count_words(batches, bits), "range long, hashes binary, counts binary")
    row = (found.groupBy("range").applyInArrow(_range_sums, "tokens long, words long, once long")
           .agg(F.sum("tokens"), F.sum("words"), F.sum("once")).first())
    return row[0] or 0, row[1] or 0, row[2] or 0


# Blocks ---------------------------------------------------------------------------------------------------------------

class Block:
    """The tokens of a block's documents: start, words, end, one document after the other."""

    def __init__(self, rows: pa.Table):
        self.vocabulary = Vocabulary()
        start, end = np.array([self.vocabulary[START]]), np.array([self.vocabulary[END]])
        texts = rows.column("text").cast(pa.binary()).to_pylist()
        parts = [p for t in texts for p in (start, numbers(t, self.vocabulary), end)]
        self.lengths = np.array([len(p) + 1 for p in parts[1::3]], np.int64)  # tokens with the end
        self.tokens = np.concatenate(parts)
        self.hashes = self.vocabulary.hashes()
        held = np.array(rows.column("held_out").to_pylist(), bool)
        learn = np.repeat(~held, self.lengths + 1)
        size = len(self.vocabulary)
        pairs = self.tokens[:-1] * size + self.tokens[1:]
        inner = self.tokens[:-1] != end[0]
        self.pairs = np.unique(pairs[inner])
        pair_counts = np.zeros(len(self.pairs), np.int64)
        seen, times = np.unique(pairs[inner & learn[:-1]], return_counts=True)
        pair_counts[np.searchsorted(self.pairs, seen)] = times
        word_counts = np.bincount(self.tokens[learn], minlength=size)
        keys = np.concatenate([self.hashes, pair_hashes(self.hashes[self.pairs // size], self.hashes[self.pairs % size])])
        self.order = np.argsort(keys)
        self.keys, self.counts = keys[self.order], np.concatenate([word_counts, pair_counts])[self.order]

    def totals(self, answered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts per word and per pair from the answers in the order of the keys."""
        if len(answered) != len(self.keys):
            raise RuntimeError(f"{len(self.keys)} keys asked for, {len(answered)} answered")
        total = np.empty(len(answered), np.int64)
        total[self.order] = answered
        return total[:len(self.vocabulary)], total[len(self.vocabulary):]


def _ask(bits: int):
    def ask(rows: pa.Table) -> pa.Table:
        block, found = rows.column("block")[0].as_py(), Block(rows)
        cut = list(zip(*cut_by_range(found.keys, found.counts, bits)))
        return pa.table([pa.array([block] * len(cut[0])), *(pa.array(c) for c in cut)], names=["block", "range", "hashes", "counts"])

    return ask


def _answer(rows: pa.Table) -> pa.Table:
    hashes = [unpacked_sorted(h) for h in rows.column("hashes").to_pylist()]
    _, total, place = added(np.concatenate(hashes), _counts(rows))
    answers = np.split(total[place].astype("<u4"), np.cumsum([len(h) for h in hashes])[:-1])
    return pa.table([rows.column("block"), rows.column("range"), pa.array([packed(a) for a in answers], pa.binary())],
                    names=["block", "range", "totals"])


class Automaton:
    """States are numbers of words (contexts) and -1, the empty context."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, start: int, end: int,
                 tokens: int, once: int, beta: float = BETA):
        p1 = np.where(words > 0, words, once + 1) / (tokens + once + 1)
        self.root = np.log10(p1).tolist()
        contexts = words.copy()
        contexts[start], contexts[end] = words[end], 0  # every document starts once; nothing follows an end
        weight = 1 / (1 + np.maximum(contexts, 1) ** (1 - beta))
        weight[contexts == 0] = 1.0
        self.failure = np.log10(weight).tolist()
        self.next = np.where(contexts > 0, np.arange(len(words)), -1).tolist()
        self.size, self.start = len(words), start
        left, right = pairs // self.size, pairs % self.size
        seen = (pair_counts > 0) & (contexts[left] > 0)
        left, right, pairs, pair_counts = left[seen], right[seen], pairs[seen], pair_counts[seen]
        p = (1 - weight[left]) * pair_counts / contexts[left] + weight[left] * p1[right]
        self.arcs = dict(zip(pairs.tolist(), np.log10(p).tolist()))

    def read(self, words: list[int]) -> float:
        """log10 of the probability of one document's tokens, the end included."""
        total, state = 0.0, self.next[self.start]
        arcs, root, failure, next_, size = self.arcs, self.root, self.failure, self.next, self.size
        for word in words:
            if state >= 0:
                step = arcs.get(state * size + word)
                total += failure[state] + root[word] if step is None else step
            else:
                total += root[word]
            state = next_[word]
        return total


def _score(tokens: int, words: int, once: int, beta: float):
    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        found = Block(rows)
        order = np.argsort(answers.column("range").to_numpy())
        blobs = answers.column("totals").to_pylist()
        counts, pair_counts = found.totals(np.concatenate([unpacked(blobs[i], "<u4") for i in order]).astype(np.int64))
        start, end = found.vocabulary[START], found.vocabulary[END]
        if counts[start]:  # it was counted among the words for convenience only
            counts[start] = 0
        automaton = Automaton(counts, found.pairs, pair_counts, start, end, tokens, once, beta)
        base, known = np.log10((counts + 1) / (tokens + words + 1)), counts > 0
        n_known, bases, scores, at = [], [], [], 0
        for n in found.lengths.tolist():
            own = found.tokens[at + 1:at + 1 + n]
            n_known.append(int(known[own].sum()))
            bases.append(float(base[own].sum()))
            scores.append(automaton.read(own.tolist()))
            at += n + 1
        return pa.table([rows.column("doc_id"), rows.column("held_out"), pa.array(found.lengths), pa.array(n_known, pa.int64()),
                         pa.array([tokens] * len(scores), pa.int64()), pa.array(bases, pa.float64()),
                         pa.array(scores, pa.float64())],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", beta: float = BETA,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows where held_out is false and scores all.
    """
    thin = docs.select(F.col(key).alias("doc_id"), held_out.alias("held_out"), text_or_empty(text).alias("text"))
    size = thin.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    bits = (blocks - 1).bit_length()
    tokens, words, once = unigram_sums(thin.where(~F.col("held_out")).select("text"), bits)
    dealt = thin.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(blocks, "block")
    asked = dealt.groupBy("block").applyInArrow(_ask(bits), "block long, range long, hashes binary, counts binary")
    answered = asked.groupBy("range").applyInArrow(_answer, "block long, range long, totals binary")
    id_type = thin.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        _score(tokens, words, once, beta),
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
