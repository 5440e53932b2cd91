"""Dictionary segmentation against all paths through the lattice."""

import random

import pytest
from pyspark.sql import functions as F

from tidemart.functions import segment, text


def plain(word_list, run):
    """The best of all paths: fewest steps, then the longest steps from the left; single characters side by side joined."""
    entries, best = set(word_list), None

    def go(i, path):
        nonlocal best
        if i == len(run):
            key = (len(path), [-len(w) for w, _ in path])
            if best is None or key < best[0]:
                best = (key, path)
            return
        steps = [run[i:j] for j in range(i + 1, len(run) + 1) if run[i:j] in entries]
        for w in steps or [run[i]]:
            go(i + len(w), [*path, (w, bool(steps))])

    go(0, [])
    out, alone = [], ""
    for w, known in best[1]:
        if known:
            out += [alone, w] if alone else [w]
            alone = ""
        else:
            alone += w
    return out + [alone] if alone else out


def test_path():
    r = random.Random(4)
    for alphabet, letters in (("ab", 12), ("abc", 11), ("数据库中国", 9)):
        for _ in range(150):
            entries = ["".join(r.choices(alphabet, k=r.randint(1, 4))) for _ in range(r.randint(0, 9))]
            run = "".join(r.choices(alphabet + "x", k=r.randint(0, letters)))
            assert segment.Trie(entries).cut(run) == (plain(entries, run) if run else [])


def test_columns_and_lateral(spark):
    words = spark.createDataFrame([("数据",), ("数据库",), ("库存",), ("Spark",), ("存",), (None,), ("",), ("two words",), ("spark",)], "word string")
    entries = segment.dictionary(words)
    assert sorted(entries) == sorted(["数据", "数据库", "库存", "spark", "存"])
    rows = spark.createDataFrame([(1, "SPARK数据库存 和x"), (2, None), (3, ""), (4, "数据库存"), (5, "!?")], "id int, item string")
    got = {r.id: r.k for r in rows.select("id", segment.segmenter(spark, entries)(F.col("item")).alias("k")).collect()}
    # Two steps either way for 数据库存: the longer first one counts.
    assert got == {1: ["spark", "数据库", "存", "和x"], 2: None, 3: [], 4: ["数据库", "存"], 5: []}
    exploded = text.tokenize_explode(rows.where("item is not null"), "item", tokenizer=segment.segmenter(spark, entries))
    assert sorted(r.keyword for r in exploded.collect()) == sorted(["spark", "数据库", "存", "和x", "数据库", "存"])
    segment.register(spark, "cut_words", entries)
    rows.createOrReplaceTempView("unspaced_items")
    found = spark.sql("SELECT id, keyword FROM unspaced_items, LATERAL cut_words(item)").collect()
    assert sorted((r.id, r.keyword) for r in found) == sorted((i, w) for i, ws in got.items() for w in ws or [])
    with pytest.raises(ValueError):
        segment.dictionary(words, limit=3)
