"""Packing: every id in exactly one piece, windows gapless and full, ids as the tokenizer gives them."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemart.llm import packing, queries

SF = "/root/testdata/sf0.001"


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4") for t in texts]


def check(rows, docs, window=4096):
    ids = defaultdict(list)
    for (doc_id, text), e in zip(docs, encoded([t for _, t in docs])):
        ids[doc_id].append(e)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, ids[doc_id]))
        if len(ids[doc_id]) == 1:
            at = 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids[doc_id][0])
                assert r.ids_crc32 == zlib.crc32(ids[doc_id][0][at:at + r.length].tobytes())
                at += r.length
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
    total = sum(r.length for r in rows)
    return len(sequences) * window / max(total, 1) - 1


def test_query(spark):
    rows = queries.op9_packing(spark, SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert check(rows, docs) < 0.02


@pytest.mark.parametrize("parts", [1, 5, 130])
def test_edges(spark, parts):
    docs = [(1, None), (2, ""), (3, "a" * 30000), (4, "a b " * 30000), (5, "x <|endoftext|> <|startoftext|>y it's"),
            (None, "null id"), (6, "Ünïcode space 　 é İ ß Σς 12 3.5"), (7, "same"), (7, "same"),
            (8, "END. It's. 'S!! don't, a.b. 12. 3,5; é. É! ???. x<|. J̌. J̌x, #a# $5% &amp; --- a-b: (c). İ.")]
    docs += [(i, f"w{i} " * (i % 97)) for i in range(100, 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    rows = packing.pack(df, queries.tokenizer_path(), window=256, most_open=4).collect()
    assert check(rows, docs, 256) < 0.2
    assert len({r.sequence_id for r in rows}) >= sum(r.length for r in rows) / 256


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, length int, part string")
    assert packing.pack(df, queries.tokenizer_path()).count() == 0
