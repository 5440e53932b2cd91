"""The pipeline's stages against plain Python, stage by stage, and all together on edge rows."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from test_mixing import plain_targets, words
from test_packing import check as check_packing
from test_simhash import plain_components, plain_fingerprint
from tidemart.llm import langid, queries

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        seen[name] = (docs.collect(), out.collect())
        assert name == "packing" or out.columns == columns
        docs = out

    before, after = seen["language_id"]
    assert {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")} == {r.doc_id for r in after}

    before, after = seen["exact_dedup"]
    last = {}
    for r in before:
        last[lower(r.text)] = max(last.get(lower(r.text), -1), r.doc_id)
    assert sorted(last.values()) == sorted(r.doc_id for r in after)
    assert {r.doc_id: r for r in before if r.doc_id in set(last.values())} == {r.doc_id: r for r in after}

    before, after = seen["near_dedup"]
    before = sorted(before, key=lambda r: r.doc_id)
    roots = plain_components([plain_fingerprint(r.text) for r in before])
    assert {before[i].doc_id for i in set(roots)} == {r.doc_id for r in after} and len(after) == len(set(roots))

    before, after = seen["mixing"]
    copies, sizes, taken = Counter(r.doc_id for r in after), defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r.source] += words(r.text)
        taken[r.source] += words(r.text) * copies[r.doc_id]
    assert set(copies) <= {r.doc_id for r in before} and max(copies.values()) <= 2
    target = plain_targets(sizes)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= max(words(r.text) for r in before if r.source == source) + 1

    before, after = seen["packing"]
    assert check_packing(after, [(r.doc_id, r.text) for r in before]) < 0.05


def test_edge_rows(spark, tmp_path, monkeypatch):
    rows = [(i, "The and of thing with that, number " + " ".join(f"word{i * j}" for j in range(i % 30)), "en", "a", 5)
            for i in range(90)]
    rows += [(None, None, None, None, None), (200, "", "en", "a", 0), (201, "12 %% 34", "en", None, 3),
             (202, "the of and " * 40_000, "en", "b", 9), (7, rows[7][1], "en", "a", 5), (203, rows[3][1].upper(), "en", "a", 1)]
    (tmp_path / "t").mkdir()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "t" / "documents.parquet"))
    pieces = pipeline.run(spark, str(tmp_path / "t")).collect()
    ids = {r.doc_id for r in pieces}
    assert not ids & {200, 201, None} and len(ids) > 5
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "e" / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path / "e")).count() == 0


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = queries.language_model(docs)
    kept = langid.keep_known(docs, model)
    with_letters = docs.where("regexp_like(text, '\\\\p{L}')").count()
    assert kept.count() >= 0.995 * with_letters
