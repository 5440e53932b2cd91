"""Substring dedup against a plain dictionary of windows."""

import hashlib
import random

import pytest

from tidemart.llm import queries, substrings

SF = "/root/testdata/sf0.001"


def plain(docs, window=50):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    least = {}
    for i, own in words:
        for p in range(len(own) - window + 1):
            least.setdefault(tuple(own[p:p + window]), set()).add(i)
    least = {k: min(x if x is not None else 1 << 62 for x in v) for k, v in least.items()}
    out = []
    for i, own in words:
        gone = set()
        for p in range(len(own) - window + 1):
            if least[tuple(own[p:p + window])] < (i if i is not None else 1 << 62):
                gone.update(range(p, p + window))
        kept = b" ".join(w for p, w in enumerate(own) if p not in gone)
        out.append((str(i), len(own), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(queries.op4_substrings(spark, sf))
    assert got == plain(docs) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("window", [2, 5, 8])
def test_shared_passages(spark, window):
    rng = random.Random(window)
    passages = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 30))) for _ in range(12)]
    docs = [(i, "\t".join(rng.choice(passages) if rng.random() < 0.7 else " ".join(rng.choices("ijkl", k=9))
                          for _ in range(rng.randint(0, 6)))) for i in range(150)]
    docs += [(None, docs[7][1]), (None, docs[7][1]), (200, None), (201, ""), (202, " \n "), (203, "x " * 3000), (204, "x " * 3000),
             (205, "É é\x1cq " * 20), (205, "É é\x1cq " * 20), (206, docs[3][1])]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, n_words int, block string")
    got = substrings.remove_repeats(df, window=window, block_bytes=1500)
    assert rows(queries.substring_digest(got)) == plain(docs, window)
    for r in got.collect():
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(df).count() == 0
