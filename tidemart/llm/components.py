"""Connected components of a list of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex hangs its larger neighbours on the smallest of its neighbours and itself."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex hangs its smaller neighbours and itself on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every vertex that is not the smallest of its component, with the smallest. Input: links a, b of any order.

    One row per link goes through a shuffle; the smallest neighbour is aggregated before it, so a vertex with very many
    links meets one row of its own. The number of rounds is logarithmic in the longest chain. The state of a round is
    a written table; the driver sees a count and a sum.
    """
    edges = written(edges.where("a <> b").distinct(), "links")
    seen = None
    while True:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return edges
        seen = tuple(now)
