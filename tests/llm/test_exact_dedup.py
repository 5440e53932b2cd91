"""Exact dedup against SQL and against plain grouping, with filters of any size."""

from collections import defaultdict

import pytest

from compare import connect, differences
from tidemart.llm import exact_dedup, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    assert differences(queries.op7_exact_dedup(spark, sf), connect(sf), queries.SQL["op7_exact_dedup"]) is None


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


DOCS = [(1, None), (2, ""), (3, "A"), (4, "a"), (5, "É"), (6, "é"), (7, " a"), (8, "a" * 500_000), (9, "A" * 500_000), (None, "a"),
        (None, "only null"), (10, "twice"), (10, "twice"), (11, "ẞ İ"), (12, "ß i̇")] + [(i, "hot") for i in range(100, 700)]
SCHEMA = "doc_id long, text string, hash string, body int, kept boolean"


@pytest.mark.parametrize("max_bits", [1 << 16, 1 << 31])
def test_edges(spark, max_bits, monkeypatch):
    if max_bits == 1 << 16:
        monkeypatch.setattr(exact_dedup, "BITS_PER_ROW", 1)
    df = spark.createDataFrame([(*d, "x", 1, None) for d in DOCS], SCHEMA).repartition(5)
    groups = defaultdict(list)
    for i, text in DOCS:
        groups[lower(text)].append(i)
    rows = exact_dedup.mark(df, max_bits=max_bits).collect()
    assert len(rows) == len(DOCS) and sum(r.kept for r in rows) == len(groups)
    expected = sorted((str(i), str(max((d for d in groups[lower(t)] if d is not None), default=None)), len(groups[lower(t)])) for i, t in DOCS)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in rows) == expected
    kept = exact_dedup.keep_last(df, max_bits=max_bits)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        (str(max((d for d in own if d is not None), default=None)),
         next(t or "" for i, t in DOCS if lower(t) == text and i == max((d for d in own if d is not None), default=None)))
        for text, own in groups.items())


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.mark(df).count() == 0 and exact_dedup.keep_last(df).count() == 0


def test_only_possible_repeats_are_shuffled(spark):
    df = spark.createDataFrame([(i, f"text {i // 2 if i < 100 else i}") for i in range(5000)], "doc_id long, text string")
    hashes = df.select(exact_dedup.normalised_sha256("text").alias("hash"))
    maybe, _ = exact_dedup.possibly_repeated(hashes, "hash", 5000)
    assert 100 <= hashes.where(maybe("hash")).count() < 800
