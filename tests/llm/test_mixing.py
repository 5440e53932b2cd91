"""Mixing: targets against repeated resharing, rates against bisection, words near their targets, hot groups, edges."""

import math
import re
from collections import defaultdict

import pytest

from tidemart.llm import mixing, queries

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, source string"


def plain_targets(sizes):
    """sizes: source -> words. Shares by weight, again and again, until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, capped, rest = dict.fromkeys(order, 0.0), set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        left = rest - sum(target[s] for s in capped)
        for s in open_:
            target[s] = left * weight[s] / sum(weight[o] for o in open_)
        above = [s for s in open_ if target[s] >= 2 * sizes[s]]
        if not above:
            return target
        for s in above:
            target[s] = 2.0 * sizes[s]
        capped.update(above)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += words(text)
    target, by_id = plain_targets(sizes), {d: (words(t), s) for d, t, s in docs}
    assert len(rows) == len(docs)
    for r in rows:
        size, source = by_id[r.doc_id]
        assert r["size"] == size and r.source_size == sizes[source] and 0 <= r.taken <= 2 * size
        assert r.target == pytest.approx(target[source], rel=1e-9, abs=1e-6)
        taken[source] += r.taken
    for source in sizes:
        largest = max(size for size, s in by_id.values() if s == source)
        assert abs(taken[source] - target[source]) <= largest + 1
    return taken, target


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = queries.op8_mixing(spark, SF).collect()
    taken, target = check(rows, docs)
    assert sum(abs(taken[s] - target[s]) for s in target) < 0.02 * sum(target.values())
    assert sorted(rows) == sorted(queries.op8_mixing(spark, SF).collect())


def test_rates_solve_the_dual(spark):
    docs = [(i, "w " * (1 + i * i % 40), f"s{i % 3}") for i in range(300)]
    rows = mixing.balance(spark.createDataFrame(docs, COLUMNS)).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[(r.source_size, r.target)].append((r["size"], r.rate))
    for (source_size, target), own in groups.items():
        assert sum(s * r for s, r in own) == pytest.approx(target, rel=1e-5)
        if target < 2 * source_size:  # log odds of the rates are proportional to the sizes
            slopes = [math.log(r / (2 - r)) / s for s, r in own if 1e-9 < r < 2 - 1e-9]
            assert max(slopes) == pytest.approx(min(slopes), rel=1e-4, abs=1e-6)


def test_hot_group_is_spread(spark):
    docs = [(i, "same words here", "a") for i in range(3000)] + [(i, "x " * (i % 50), f"s{i % 4}") for i in range(3000, 5000)]
    rows = mixing.balance(spark.createDataFrame(docs, COLUMNS)).collect()
    check(rows, docs)


def test_edges(spark):
    docs = [(1, None, "a"), (2, "", None), (3, "one", None), (4, "two words", "a"), (5, "long " * 50_000, "b"),
            (6, "é 　 ü", ""), (7, "tab\tline\nfeed", "b"), (8, "q", "z")]
    df = spark.createDataFrame([(*d, 1, "x", 2.0) for d in docs], COLUMNS + ", size int, owner string, target double")
    rows = mixing.balance(df).collect()
    assert {r.doc_id: r["size"] for r in rows} == {1: 0, 2: 0, 3: 1, 4: 2, 5: 50_000, 6: 3, 7: 3, 8: 1}
    check(rows, docs)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    copies = {r.doc_id: r.copies for r in rows}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(d for d, c in copies.items() for _ in range(c))
    assert mixing.balance(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0
    empty = mixing.balance(spark.createDataFrame([(1, None, "a"), (2, "", "b")], COLUMNS)).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0), (0.0, 0)]


def test_repeated_rows(spark):
    docs = [(1, "a b c", "s")] * 3 + [(None, "d e", None)] * 4
    df = spark.createDataFrame(docs, COLUMNS)
    rows = mixing.balance(df).collect()
    assert len(rows) == 7 and len({tuple(r) for r in rows}) == 2
    assert mixing.mix(df).count() == sum(r.copies for r in rows)


def test_no_python_on_the_main_path(spark):
    plan = queries.op8_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
