"""The dealt operators as queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup, html_text, jaccard_join, langid, lm, mixing, order_minhash, packing, pii, prefix_trie, simhash, substrings,
    token_align)
from .common import learned, prepared, table

Query = Callable[[SparkSession, str], DataFrame]


def language_model(docs: DataFrame) -> langid.Model | None:
    return langid.fit(docs.where(~learned("doc_id", 5, 0)))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    told = langid.predict(docs, language_model(docs))
    return docs.select("doc_id", learned("doc_id", 5, 0).alias("held_out"), told.alias("told")).select(
        "doc_id", "held_out", "told.*")


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(prepared(spark), sf_dir, "documents"), learned("doc_id", 7, 2))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_neighbours(table(prepared(spark), sf_dir, "documents"))


def substring_digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digest(substrings.remove_repeats(table(prepared(spark), sf_dir, "documents")))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(prepared(spark), sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key comes from the session; without one a public test key makes runs comparable, but hides nothing."""
    secret = spark.conf.get("spark.tidemart.pii.key", "public test key").encode()
    found = pii.pseudonymise(table(prepared(spark), sf_dir, "documents"), secret)
    return found.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), "found")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(prepared(spark), sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.balance(table(prepared(spark), sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(prepared(spark), sf_dir, "documents"), tokenizer_path())


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(prepared(spark), sf_dir, "documents"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_align.align(table(prepared(spark), sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                              tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation starts with turns of the one whose id ends in 00, as many as crc32 of its id modulo 6."""
    turns = prefix_trie.numbered(table(prepared(spark), sf_dir, "conversations"))
    conv = F.col("conv")
    return prefix_trie.build(*prefix_trie.replanted(turns, conv - conv % 100, F.crc32(conv.cast("string")) % 6, 5))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(prepared(spark), sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_language_id, op2_lm, op3_order_minhash, op4_substrings, op5_html_text, op6_pii, op7_exact_dedup, op8_mixing,
    op9_packing, op10_simhash, op11_token_align, op12_prefix_trie, op13_jaccard_join)}

SQL: dict[str, str] = {"op7_exact_dedup": exact_dedup.SQL}
