"""Search text to words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# Everything that is neither a letter nor a digit separates words.
SEPARATORS = r"[^\p{L}\p{N}]+"


def words(text) -> Column:
    """Lower-cased words of a text, without empty ones."""
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def tokenize_explode(
    df: DataFrame, text: str, out: str = "keyword", tokenizer: Callable[[Column], Column] = words
) -> DataFrame:
    """One row per word. `tokenizer` maps a text column to an array column: the built-in split by
    default, or a pandas UDF around a dictionary segmenter."""
    return df.withColumn(out, F.explode(tokenizer(F.col(text)))).drop(text)
