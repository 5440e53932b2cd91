"""Language model: counts, base and score against plain dictionaries; the distribution sums to one; edges."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.llm import lm, queries

SF = "/root/testdata/sf0.001"


def plain(docs, held, beta=lm.BETA):
    """doc_id -> (n_tokens, n_known, N, base, score)."""
    tokens = {i: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split() + [None]
              for i, t in docs}
    count, pairs = Counter(), Counter()
    for i, own in tokens.items():
        if not held(i):
            count.update(own)
            pairs.update(zip(["start"] + own, own))
    n, v, once = sum(count.values()), len(count), sum(c == 1 for c in count.values())

    def p1(w):
        return (count[w] or once + 1) / (n + once + 1)

    def p(w, u):
        c = count[None] if u == "start" else count[u]
        if not c:
            return p1(w)
        weight = 1 / (1 + c ** (1 - beta))
        return (1 - weight) * pairs[u, w] / c + weight * p1(w)

    return {i: (len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own),
                sum(math.log10(p(w, u)) for u, w in zip(["start"] + own, own))) for i, own in tokens.items()}, p, count


def check(rows, docs, held):
    expected, _, _ = plain(docs, held)
    assert len(rows) == len(docs)
    for r in rows:
        n, known, train, base, score = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9) and r.score == pytest.approx(score, rel=1e-9, abs=1e-9)


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op2_lm(spark, SF).collect()
    check(rows, docs, held)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out)  # both negative: the model tells more


def test_many_blocks_and_edges(spark):
    docs = [(1, None), (2, ""), (3, "A a A b"), (4, " \t\n"), (5, "É é"), (6, "hot " * 50_000), (7, "\x1c x\x85y"), (8, "end start")]
    docs += [(i, "the same text") for i in range(20, 60)] + [(i, f"word{i % 5} the word{i}") for i in range(60, 300)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n_tokens int, block string")
    flag = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    check(lm.score(df, flag, block_bytes=2000).collect(), docs, held)
    assert lm.score(df.limit(0), flag).count() == 0
    nothing = lm.score(df.where("doc_id = 3"), F.lit(True)).collect()[0]
    assert (nothing.train_tokens, nothing.base_score, nothing.score, nothing.n_known) == (0, 0.0, 0.0, 0)


def test_sums_to_one():
    docs = [(i, f"a b w{i} c{i % 3} a") for i in range(30)]
    _, p, count = plain(docs, lambda i: i % 4 == 0)
    for context in ["start", b"a", b"b", b"w1", b"never"]:
        assert sum(p(w, context) for w in [*count, b"unseen word"]) == pytest.approx(1)
