"""Alignment against plain encoding of whole texts, offset by offset."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemart.llm import queries, token_align
from tidemart.llm.substrings import mixed

SF = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.byte = {chr(b): b for b in printable}
        for b in range(256):
            if b not in printable:
                self.byte[chr(256 + len(self.byte) - len(printable))] = b

    def groups(self, text):
        """List of (ids of A, ids of B), or None without tokens."""
        if not text:
            return None
        data = (" " + text).encode()
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            return None
        out, at_a, at_b, own_a, own_b = [], 0, 0, [], []
        rest = iter(b)
        for i, x in a:
            own_a.append(i)
            at_a += len(x)
            while at_b < at_a:
                j, y = next(rest)
                own_b.append(j)
                at_b += len(y)
            if at_a == at_b:
                out.append((own_a, own_b))
                own_a, own_b = [], []
        return out


def plain(docs):
    found = [(d, Plain.one.groups(t)) for d, t in docs]
    count = Counter((a[-1], b[-1]) for _, g in found for a, b in g or ())
    best = {}
    for (_, b), c in count.items():
        best[b] = max(best.get(b, 0), c)
    rows = []
    for d, g in found:
        g = g or []
        links = [(a[-1], b[-1]) for a, b in g]
        rows.append((d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g), sum(count[x] == best[x[1]] for x in links),
                     sum(count[x] for x in links), ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)))
    return sorted(rows, key=str)


Plain.one = Plain()


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain(docs)]
    rows = queries.op11_token_align(spark, SF).select(*COLUMNS[:-1], "groups_sha256").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


TEXTS = [
    None, "", " ", "\n", "a", "  two  spaces  ", "tab\t and newline\n  indent\n\n", "it's we'll I'd've 'tis don't''s", "<|endoftext|> <s></s><unk> <0x41>",
    "▁ under ▁x", "x▁", "é è é ﬁ Å", "漢字かな 한글 עברית ا", "😀👍🏽 end", "non\xa0breaking \xa0 x　 y z ​ q", "a\x1cb !\x1c \x85 c",
    "\x00\x01 nul", "1234567 3.14 1,000.00 a1b2 ²³ ½", "Καλημέρα κόσμε", "Привет, мир! Ёж", "ÿĀǅ ǆ ƒoo ȀB", "x" * 5000, "ab " * 3000,
    "." * 300 + " ..." + "!?" * 50, "end with space ", "end with newline\n", "᠎ x ᠎", "İstanbul ıI ſ ß ẞ", "<|endoftext|>", "'s 's", "a's'S",
    "trailing  sep   x", "word." * 200, " lead", "\t\t x", "a  b", "Ǆ Ϗ Ϣ ҂ Ҋ ԱԲ", "ªµº", "﻿ bom ﻿",
]


@pytest.mark.parametrize("way", ["table", "join", "small"])
def test_edges(spark, monkeypatch, way):
    docs = [(i if i != 7 else None, t) for i, t in enumerate(TEXTS + TEXTS[4:9])]
    df = spark.createDataFrame([(d, t, 1, "g") for d, t in docs], "doc_id long, text string, keys int, groups string").repartition(3)
    if way == "small":  # many chunks' worth of segments, memory that is full all the time
        for name, value in (("SEGMENT_PAIRS", 16), ("FAN_IN", 2), ("REMEMBERED_WORDS", 20), ("OUT_ROWS", 3), ("CHAIN", 40)):
            monkeypatch.setattr(token_align, name, value)
    assert found(token_align.align(df, A, B, table_pairs=0 if way == "join" else None)) == plain(docs)
    if way == "table":
        assert found(token_align.align(df.limit(0), A, B)) == []
        assert found(token_align.align(df.where("text is null"), A, B)) == [(0, 0, 0, 0, 0, 0, 0, "")]


def test_units_are_whole_texts():
    """Texts cut into units give what whole texts give."""
    pair = token_align.Pair(A, B)
    assert pair.by_units
    texts = [t for t in TEXTS if t]
    cut = 0
    for text, units in zip(texts, pair.units_of(texts)):
        whole = pair.whole(" " + text)
        if units is not None:
            cut += 1
            assert ";".join(pair.groups[i] for i in units) == whole[2]
            assert pair.keys.of(units).tolist() == whole[3].tolist()
    assert cut > 20


def test_perfect():
    """Every key has a place of its own, without gaps; a key that is not in the table is told."""
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 31, 20_000, dtype=np.uint64))
    own = (mixed(keys) >> np.uint64(62)).astype(int)
    built = [token_align.perfect(keys[own == s]) for s in range(4)]
    places = token_align.Places.of(2, [0, 1, 2, 3], *([b[i] for b in built] for i in range(3)))
    assert sorted(places.find(keys).tolist()) == list(range(len(keys)))
    assert places.find(np.arange(1 << 40, (1 << 40) + 1000, dtype=np.uint64)).tolist() == [-1] * 1000
    counts = token_align.Counts(places, np.ones(len(keys), np.int64), np.ones(10, np.int64), 10)
    assert counts.of_links(keys[:7].astype(np.int64)) == (7, 7)
    with pytest.raises(ValueError):
        counts.of_links(np.array([1 << 40]))
