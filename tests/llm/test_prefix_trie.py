"""The prefix trie against a plain one that walks every conversation."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemart.llm import prefix_trie, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_turns(rows):
    """conv -> turns in order."""
    out = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (
            r[0], r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def plain_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in own) or 1
        saved[node] = sum(saved[k] for k in own) + (len(node[-1][1]) * (len(members[node]) - 1) if node else 0)
    return sorted((
        min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(kids.get(n, [])), leaves[n], saved[n],
        hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(n)))).encode()).hexdigest())
        for n, m in members.items())


def found(df):
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, df.select(*COLUMNS).collect()))


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_prefix_trie(spark, sf)) == plain_trie(plain_rebuilt(plain_turns(rows)))


def trie(spark, rows, schema="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, schema)
    return found(prefix_trie.build(prefix_trie.numbered(df)))


def test_deep_shared_and_parting(spark):
    """Copies, prefixes of others, partings inside and at the edges of blocks, one long conversation."""
    rows = []
    for c in range(60):
        n = 3 + c % 9
        for t in range(n):
            parted = t >= 2 + c % 7
            rows.append((c, t, "user" if t % 2 else "system", f"turn {t} {c % 4 if parted else ''}é"))
    rows += [(100 + c, t, "user", f"turn {t}") for c in range(30) for t in range(11)]
    rows += [(500, t, "user", str(t // 3)) for t in range(700)]
    assert trie(spark, rows) == plain_trie(plain_turns(rows))


def test_long_runs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN_OF_BLOCKS", 2)
    rows = [(c, t, "u", f"{t if t < 20 + c % 3 else -c}") for c in range(12) for t in range(30 + c)]
    assert trie(spark, rows) == plain_trie(plain_turns(rows))


def test_edges(spark):
    rows = [(1, None, None, "x"), (1, 1, "user", None), (1, 1, "user", None), (2, None, "", "x"), (2, 3, "user", ""),
            (None, 1, "user", "lost"), (-7, 0, "a", "b" * 200_000), (-7, 0, "ab", ""), (5, 0, "a", "b"), (6, 0, "", "ab")]
    assert trie(spark, rows) == plain_trie(plain_turns(rows))
    more = [(*r, 9, "k") for r in rows]
    assert trie(spark, more, "conv_id long, turn long, role string, text string, position int, digest string") == \
        plain_trie(plain_turns(rows))
    assert trie(spark, []) == []


def test_turnless(spark):
    """Conversations that lose their turns stay members of the root."""
    rows = [(c, t, "u", f"{c} {t}") for c in (101, 102, 103, 104, 105, 106, 200, 203, 207) for t in range(2)]
    turns = prefix_trie.numbered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    built = prefix_trie.build(*prefix_trie.replanted(turns, F.col("conv") - F.col("conv") % 100,
                                                     F.crc32(F.col("conv").cast("string")) % 6, 5))
    expected = plain_trie(plain_rebuilt(plain_turns(rows)))
    assert found(built) == expected
    assert hashlib.sha256(b"").hexdigest() != next(r for r in expected if r[1] == 0)[-1]
    single = spark.createDataFrame([(c,) for c in (3, 4)], "conv long")
    alone = found(prefix_trie.build(turns.limit(0), single))
    assert alone == plain_trie({3: [], 4: []})


def test_runs_of_ids(spark, monkeypatch):
    """Very many members end in one node: their ids come in several runs."""
    monkeypatch.setattr(prefix_trie, "ID_BITS", 2)
    rows = [(c, 0, "u", "same") for c in range(-30, 100, 3)] + [(c, 0, "u", f"{c}") for c in range(1, 20, 3)]
    assert trie(spark, rows) == plain_trie(plain_turns(rows))
