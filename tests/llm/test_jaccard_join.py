"""The Jaccard join against sets of strings, all pairs."""

import random

import numpy as np
import pytest

from tidemart.llm import jaccard_join, queries

SF = "/root/testdata/sf0.001"


def plain_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2)))


def plain(docs):
    """(doc_id, n, component) by all pairs."""
    sets = [plain_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for t in s:
            where.setdefault(t, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for t in s for j in where[t] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 90 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(s), ids.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def check(df, docs):
    assert sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str) == plain(docs)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op13_jaccard_join(spark, sf), docs)


def edited(words, r, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10 ** 6)}"
    return words


def crowd(r, copies):
    """Groups of near copies on both sides of the threshold, with passages that all share."""
    docs, line = [], [f"common{i}" for i in range(40)]
    for g in range(4):
        base = [f"w{g}x{r.randrange(300)}" for _ in range(40 * (g + 1))]
        for c in range(copies):
            docs.append(" ".join(edited(base, r, c % (g + 3)) + line * (c % 2)))
    docs += [" ".join(line + [f"only{i}"] * (i % 4)) for i in range(copies)]
    r.shuffle(docs)
    return list(enumerate(docs, 100))


@pytest.mark.parametrize("blocks", [False, True])
def test_crowd(spark, monkeypatch, blocks):
    """Also with many blocks in a bucket, parts in a group, blocks and ranges in the count."""
    docs = crowd(random.Random(5), 60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    if blocks:
        monkeypatch.setattr(jaccard_join, "BLOCK", 16)
        full = jaccard_join.shingle_sets
        monkeypatch.setattr(jaccard_join, "shingle_sets", lambda *a: full(*a, block_bytes=4096, range_bytes=8192))
        check(jaccard_join.linked(df, part=900), docs)
    else:
        check(jaccard_join.linked(df), docs)


def test_threshold(spark):
    """Exactly 0.9 links: 18 of 20 shingles in common; 17 of 20 do not."""
    a = [f"a{i}" for i in range(21)]
    docs = [(1, " ".join(a)), (2, " ".join(a[:20] + ["z"])), (3, " ".join(a[:19] + ["y", "z"])), (4, " ".join(a[:20])),
            (5, " ".join(a[1:]))]
    check(jaccard_join.linked(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, "A  B"), (8, "b a"), (9, "a b c"), (10, "a b c"),
            (10, "a b c"), (11, "É é x"), (12, "é É x"), (13, long), (14, long + " more"), (15, "x" * 3_000_000), (16, "X" * 3_000_000),
            (None, "a b c"), (None, "lost"), (None, None), (17, "a b a b a b")]
    df = spark.createDataFrame([(d, t, 7, b"k") for d, t in docs], "doc_id long, text string, n long, tokens binary")
    check(jaccard_join.linked(df), docs)
    assert jaccard_join.linked(df.limit(0)).count() == 0
    check(jaccard_join.linked(df.where("doc_id < 4")), docs[:3])


def test_words():
    """One word longer than a slab, words over the edges of slabs."""
    texts = [b"Ab c", b"x" * (1 << 20) + b" y", b"", b"ab C " * 400_000, b"q" * (5 << 20), b" ab\x0bc\n"]
    hashes, counts = jaccard_join.all_words(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    ends = np.cumsum(counts)
    by = [hashes[e - c:e].tolist() for e, c in zip(ends, counts)]
    assert by[0] == by[5] == by[3][:2] and len(set(by[3])) == 2 and len({h for x in by for h in x}) == 5
    assert by[4] == jaccard_join.all_words([b"Q" * (5 << 20)])[0].tolist()
