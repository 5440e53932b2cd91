"""Order MinHash: the order of documents and the edits exactly, signatures against a plain selection, likeness by edit distance."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemart.llm import order_minhash as omh
from tidemart.llm import queries

SF = "/root/testdata/sf0.001"


def check(rows, docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in rows}
    prints = {i: omh.signature(t or "") for i, t in docs}
    for n, (i, text) in enumerate(docs):
        text, r = text or "", by_id[i]
        j, following = docs[(n + 1) % len(docs)]
        half = len(text) // 2
        edit = text[:len(text) - half] + (following or "")[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (omh.as_text(prints[i]), omh.as_text(omh.signature(edit)))
        assert r.near_edited == omh.likeness(prints[i], omh.signature(edit))
        assert r.near_next == omh.likeness(prints[i], prints[j])


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op3_order_minhash(spark, SF).collect(), docs)


@pytest.mark.parametrize("range_bytes", [50, 2000, 1 << 24])
def test_edges(spark, range_bytes):
    docs = [(1, None), (2, ""), (3, "a"), (4, "ab"), (5, "é 𝒳 text"), (-6, "x" * 20_000), (None, "null id"), (9, "same"), (10, "same")]
    docs += [(i, f"document {i} " * (i % 9)) for i in range(20, 60)]
    df = spark.createDataFrame([(*d, 3, "k") for d in docs], "doc_id long, text string, part int, edge string")
    check(omh.compare_neighbours(df, range_bytes=range_bytes).collect(), docs)
    one = omh.compare_neighbours(df.where("doc_id = 5"), range_bytes=range_bytes).collect()
    check(one, [(5, "é 𝒳 text")])
    assert omh.compare_neighbours(df.limit(0)).count() == 0
    twice = omh.compare_neighbours(df.where("doc_id > 8 AND doc_id < 11").union(df.where("doc_id = 9"))).collect()
    assert len(twice) == 3 and len({r.fingerprint for r in twice}) == 1 and all(r.near_next == 1 for r in twice)


def test_signature_selects_least_in_text_order():
    rng = random.Random(4)
    for n in (0, 1, 5, 6, 7, 40, 5000, 9000):
        text = "".join(rng.choices("ab cd", k=n))
        kmers = omh.numbered_kmers(text)
        assert len(set(kmers.tolist())) == len(kmers) == max(1, n - omh.K + 1)
        grams, seen = [text[i:i + omh.K] for i in range(len(kmers))], Counter()
        first = {}
        for g, h in zip(grams, kmers.tolist()):  # the same k-mer and number have the same hash, whatever the text
            first[g, seen[g]] = h
            seen[g] += 1
        again = omh.numbered_kmers("zz" + text).tolist()
        assert n < omh.K or set(first.values()) <= set(again)
        expected = np.full(omh.SIZE, np.uint64(min(len(kmers), omh.PICKS)))
        for f in range(omh.SIZE):
            v = [(int(h) >> 32) * int(omh.FACTORS[f, 0]) + int(omh.OFFSETS[f, 0]) & 0xFFFFFFFF for h in kmers]
            v = [(x ^ x >> 15, i) for i, x in enumerate(v)]
            for i in sorted(i for _, i in sorted(v)[:omh.PICKS]):
                mix = np.array([(int(expected[f]) * 0x9E3779B97F4A7C15 + int(kmers[i])) & (1 << 64) - 1], np.uint64)
                expected[f] = omh.mixed(mix)[0]
        assert (omh.signature(text) == (expected >> np.uint64(48)).astype(np.uint16)).all()


def test_likeness_follows_edits_and_order():
    rng = random.Random(2)
    near, far, moved = [], [], []
    for _ in range(12):
        words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(300)]
        text = " ".join(words)
        some = words.copy()
        for i in rng.sample(range(300), 6):
            some[i] = "zzzzz"
        half = words[:150] + ["".join(rng.choices("klmno", k=5)) for _ in range(150)]
        turned = words[150:] + words[:150]
        a = omh.signature(text)
        near.append(omh.likeness(a, omh.signature(" ".join(some))))
        far.append(omh.likeness(a, omh.signature(" ".join(half))))
        moved.append(omh.likeness(a, omh.signature(" ".join(turned))))
    assert np.mean(near) > 0.6 > 0.35 > np.mean(far) > 0.02
    assert 0.3 < np.mean(moved) < 0.75  # the same k-mers in another order
