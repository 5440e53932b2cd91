"""Words of text without spaces, by a dictionary.

All dictionary words that a text has are a lattice over its characters; where none begins, the character stands alone. Of the
paths through the lattice the one with the fewest steps counts, of several the one whose first step is longest, then the
second, and so on. Characters that stand alone side by side come out as one word. Text is lower-cased and cut at everything that is
neither letter nor digit first.

The dictionary is a table with a word column. It goes to every task, so its size is checked: LIMIT characters at most. It is
kept as a trie, so a text is looked through once per starting character, up to the longest word that goes on there.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .text import words

# Workers get the trie with the query and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 50_000_000
END = ""  # no character


class Trie:
    """Words by their characters; matches(text, i) gives the ends of the words that begin at i."""

    def __init__(self, entries: list[str]):
        self.root: dict = {}
        for word in entries:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[END] = True

    def matches(self, text: str, i: int) -> list[int]:
        node, ends = self.root, []
        for j in range(i, len(text)):
            node = node.get(text[j])
            if node is None:
                break
            if END in node:
                ends.append(j + 1)
        return ends

    def cut(self, text: str) -> list[str]:
        """The words of one run of letters and digits."""
        n = len(text)
        steps, to, known = [0] * (n + 1), [n] * n, [False] * n
        for i in range(n - 1, -1, -1):
            ends = self.matches(text, i)
            known[i] = bool(ends)
            # Fewest steps; of equal ones the longest first step, which then is followed by the best rest.
            to[i] = min(ends or [i + 1], key=lambda j: (steps[j], -j))
            steps[i] = steps[to[i]] + 1
        out, alone, i = [], "", 0
        while i < n:
            if known[i]:
                out += [alone, text[i:to[i]]] if alone else [text[i:to[i]]]
                alone = ""
            else:
                alone += text[i]
            i = to[i]
        return out + [alone] if alone else out


def dictionary(rows: DataFrame, word: str = "word", limit: int = LIMIT) -> list[str]:
    """The distinct words of a table, lower-cased, without what is no single run of letters and digits."""
    own = rows.select(F.lower(F.col(word)).alias("word")).where(r"word rlike '^[\\p{L}\\p{N}]+$'").distinct()
    size = own.agg(F.sum(F.char_length("word"))).first()[0] or 0
    if size > limit:
        raise ValueError(f"the dictionary has {size} characters, more than {limit}: it would not fit beside every task")
    return [r.word for r in own.toLocalIterator()]


def segmenter(spark: SparkSession, entries: list[str]) -> Callable[[Column], Column]:
    """A tokenizer for text.tokenize_explode and the keyword metric: a text column to an array of words."""
    shared = spark.sparkContext.broadcast(entries)

    @F.pandas_udf("array<string>")
    def cut(runs: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie = Trie(shared.value)  # once per task
        for batch in runs:
            yield batch.map(lambda some: None if some is None else [w for run in some for w in trie.cut(run)])

    return lambda column: cut(words(column))


def register(spark: SparkSession, name: str, entries: list[str]) -> None:
    """The same as a table function for SQL: SELECT keyword FROM t, LATERAL name(t.text)."""
    shared = spark.sparkContext.broadcast(entries)

    class Segment:
        def __init__(self):
            self.trie = None

        def eval(self, text: str):
            import re

            self.trie = self.trie or Trie(shared.value)
            for run in re.split(r"[\W_]+", (text or "").lower()):
                for word in self.trie.cut(run):
                    yield (word,)

    spark.udtf.register(name, F.udtf(Segment, returnType="keyword: string"))
