"""SimHash: fingerprints and components against plain brute force, on given and on crowded fixtures."""

import numpy as np
import pytest
import xxhash

from tidemart.llm import components, queries, simhash

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """Smallest index of each one's component."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    array = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def check(rows, docs):
    docs = sorted(docs, key=lambda d: d[0])
    prints = [plain_fingerprint(t) for _, t in docs]
    roots = plain_components(prints)
    expected = sorted((d[0], f"{p:016x}", docs[r][0]) for d, p, r in zip(docs, prints, roots))
    assert sorted(map(tuple, rows)) == expected


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op10_simhash(spark, sf).collect(), docs)


def test_edges(spark):
    docs = [(5, None), (6, ""), (7, " \t\n"), (8, "One"), (9, "one"), (10, "a b"), (11, "A  B"), (12, "a b c"),
            (13, "x y z w"), (14, "É é"), (15, "x y z w"), (16, "lang " * 200_000), (17, "word " * 3)]
    df = spark.createDataFrame([(d, t, 0, "k") for d, t in docs], "doc_id long, text string, print int, component_id string")
    check(simhash.near_duplicates(df).collect(), docs)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    rows = simhash.near_duplicates(spark.createDataFrame([(None, "q")], "doc_id long, text string")).collect()
    assert rows[0].component_id is None


def test_crowded_buckets(spark, monkeypatch):
    """A third of all fingerprints in a few bits of each other: many blocks, chains, and lonely ones."""
    monkeypatch.setattr(simhash, "BLOCK", 64)
    random = np.random.default_rng(3)
    base = random.integers(0, 2 ** 63, 3, dtype=np.uint64)
    prints = [int(p) for p in random.integers(0, 2 ** 63, 600, dtype=np.uint64)]
    for b in base:
        for flips in range(250):
            p = int(b)
            for bit in random.integers(0, 64, 1 + flips % 9):
                p ^= 1 << int(bit)
            prints.append(p)
    chain = int(base[0])
    for i in range(0, 60, 3):
        chain ^= 0b111 << i
        prints.append(chain)
    prints = sorted(set(prints), key=lambda p: p - 2 ** 64 if p >= 2 ** 63 else p)
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    linked = {r.a: r.b for r in components.components(simhash.near_links(df)).collect()}
    assert [linked.get(p, p) for p in signed] == [signed[r] for r in plain_components(prints)]


def test_bit_sliced_distances():
    random = np.random.default_rng(5)
    prints = np.unique(random.integers(0, 2 ** 63, 200, dtype=np.uint64) & np.uint64(0xF0F0000000000FFF))
    for radius in (0, 1, 3, 7):
        links = simhash.near_rows(prints, 0, len(prints), simhash.planes(prints), radius)
        bits = np.unpackbits(links.view(np.uint8), axis=1, bitorder="little")[:, :len(prints)].astype(bool)
        assert (bits == (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius)).all()


def test_no_links(spark):
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
