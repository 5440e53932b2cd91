"""Language ID: held-out accuracy, honest confidence, rejection, edge texts."""

import numpy as np

from tidemart.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op1_language_id(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.lang is not None and r.text]
    right = [r.lang_pred == r.lang for r in held]
    assert len(held) > 150 and np.mean(right) > 0.98
    assert np.mean([r.score for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.rejected for r in held]) < 0.01


def test_edges(spark):
    words = {"en": "the and of thing with that", "de": "der und nicht schön über eine", "fr": "le où été avec ça être"}
    docs = [(i, " ".join(np.random.default_rng(i).permutation(text.split() * 3)), lang)
            for i, (lang, text) in enumerate(list(words.items()) * 60)]
    train = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(train)
    texts = [None, "", "123 %% ... 456", "日本語のテキストです 漢字 仮名", "THE AND OF", "über " * 300_000, "schön", "\x00", "a"]
    got = spark.createDataFrame([(t, "x", 1.5) for t in texts], "text string, lang_pred string, score double")
    rows = got.select(langid.predict(got, model).alias("p")).collect()
    pred = [(r.p.lang_pred, r.p.rejected) for r in rows]
    assert pred[0] == pred[1] == pred[2] == pred[7] == ("und", True)
    assert pred[3][1] and pred[4] == ("en", False) and pred[5] == ("de", False) and pred[6][0] == "de"
    kept = langid.keep_known(got, model)
    assert kept.columns == got.columns and {r.text for r in kept.collect()} >= {"THE AND OF", "schön"}
    assert all(r.p.score == 0.0 for r in rows[:3])


def test_nothing_learned(spark):
    none = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = langid.fit(none)
    assert model is None
    assert [r.p.lang_pred for r in none.select(langid.predict(none, model).alias("p")).collect()] == ["und", "und"]
    assert langid.keep_known(none.limit(0), model).count() == 0


def test_table_equals_counts():
    """The fast sums and the counted features give the same mean."""
    random = np.random.default_rng(1)
    model = langid.Model(["a", "b"], random.normal(size=(langid.BUCKETS, langid.DIM)).astype(np.float32),
                         random.normal(size=(langid.DIM, 2)).astype(np.float32), np.zeros(2, np.float32))
    texts = ["One two, three.", "", "é", "x" * 50, "a b c d", "long text " * 500]
    sums, sizes = model.sums(texts)
    for text, s, n in zip(texts, sums, sizes):
        bucket, count = langid.counts(text)
        assert n == count.sum()
        np.testing.assert_allclose(s, count @ model.table[bucket] if len(bucket) else 0, rtol=1e-3, atol=1e-3)
