"""Mixing sources to target weights by entropy balancing, in DataFrame operations alone.

Targets. Sources in code point order (null last) weigh 5, 2, 1, repeating. They share 150 % of all words by weight; a
target stops at twice its source's words, and the excess is shared again. That is a water level: sorted by cap per
weight, the sources below the level stand at their caps, the others at level times weight.

Rates. Every document of a source gets the rate r = 2 / (1 + exp(-lambda x)), x its size over the source's scale: of all
rates between 0 and 2 that meet the token constraint, these deviate least from rate 1 in (Fermi) entropy. lambda solves
the convex dual of the constraint. Newton's method runs for all sources at once, over the number of documents per source
and size, with a bracket that catches steps that leave it. Sources whose target is their cap have the rate 2.

Copies. Within a source and sorted by size, each document gets floor(r) copies and the fractions are collected: whenever
their running sum passes a whole number, one document more is taken. The source's words thus miss its target by less
than its largest document; of 32 starting points of the sum the one that misses least is taken. The running sum is over
sizes; which documents of a size are taken is decided by a hash of id and text, in groups of about the square root of
their number, so a size that a third of all rows share is still spread.

Null text has size 0. Rows equal in id, text and source share one fate. Empty tables give empty results; if all texts
are empty, all targets are 0. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, text_or_empty, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
STARTS = 32
TOLERANCE = 1e-7
MAX_ROUNDS = 200


def owner(source: str = "source") -> Column:
    """The source as a key that sorts by code point, null last."""
    return F.when(F.col(source).isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def keys(docs: DataFrame, key: str, text: str, source: str) -> list[Column]:
    return [owner(source).alias("owner"), F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.col(key), F.col(text)).alias("pick")]


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(owner, source_size, target, capped) from (owner, source_size). One row per source: the ranks need one task."""
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy("owner")) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    capped = ranked.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "owner")
    all_ = Window.partitionBy()
    rest = (share * F.sum("source_size").over(all_)
            - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    weights_left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    filled = capped.withColumn("level", rest / weights_left).withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(all_)  # the first source above the level sees it right
    return filled.withColumn("final", level).select(
        "owner", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("final")).alias("target"),
        "capped")


def _sigma(x: Column) -> Column:
    return F.when(x >= 0, 1 / (1 + F.exp(-x))).otherwise(F.exp(x) / (1 + F.exp(x)))


def solve(cells: DataFrame, goals: DataFrame, most: float = MOST) -> DataFrame:
    """(owner, lambda) of the dual for all sources whose target lies below their cap.

    A round is one aggregation of all cells and one written row per source; the driver sees how many are still open.
    """
    x, lam = F.col("size") / F.col("scale"), F.col("lam")
    words = F.col("n") * F.col("size").cast("double")
    scale = cells.groupBy("owner").agg(F.try_divide(F.sum(words * F.col("size")), F.sum(words)).alias("scale"))
    state = written(goals.where(~F.col("capped")).join(scale, "owner").select(
        "owner", "target", "scale", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"), F.lit(False).alias("done")), "balance")
    for _ in range(MAX_ROUNDS):
        sums = cells.join(state, "owner").groupBy("owner").agg(
            F.sum(words * most * _sigma(lam * x)).alias("words"),
            F.sum(words * most * x * _sigma(lam * x) * _sigma(-lam * x)).alias("slope"))
        miss = F.col("words") - F.col("target")
        moved = state.join(sums, "owner").withColumn("miss", miss).withColumns({
            "done": F.abs("miss") <= TOLERANCE * F.greatest("target", F.lit(1.0)),
            "low": F.when(F.col("miss") < 0, lam).otherwise(F.col("low")),
            "high": F.when(F.col("miss") > 0, lam).otherwise(F.col("high"))})
        newton = moved.withColumn("next", F.when(F.col("slope") > 0, lam - F.col("miss") / F.col("slope")))
        inside = ((F.col("next") > F.coalesce("low", F.lit(float("-inf"))))
                  & (F.col("next") < F.coalesce("high", F.lit(float("inf")))))
        caught = (F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
                  .when(F.col("miss") < 0, 2 * F.greatest(lam, F.lit(1.0)))
                  .otherwise(2 * F.least(lam, F.lit(-1.0))))
        # Past the first rounds a bracket that no longer shrinks in doubles is as near as doubles come.
        stuck = (F.col("high") - F.col("low")) <= 1e-15 * F.greatest(F.abs("low"), F.abs("high"), F.lit(1e-300))
        state = written(newton.select(
            "owner", "target", "scale",
            F.when(F.col("done"), lam).when(inside, F.col("next")).otherwise(caught).alias("lam"), "low", "high",
            (F.col("done") | F.coalesce(stuck, F.lit(False))).alias("done")), "balance")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("owner", "lam", "scale")


def _copies(thin: DataFrame, most: float = MOST) -> tuple[DataFrame, DataFrame]:
    """(owner, size, pick, copies, rate) per distinct document, and the goals, from (owner, size, pick)."""
    cells = written(thin.groupBy("owner", "size").agg(F.count(F.lit(1)).alias("n")), "balance")
    goals = written(targets(cells.groupBy("owner").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))), "balance")
    tilt = solve(cells, goals, most)
    rate = F.when(F.col("capped"), F.lit(most)).otherwise(most * _sigma(F.col("lam") * F.col("size") / F.col("scale")))
    rated = (cells.join(goals, "owner").join(tilt, "owner", "left").withColumn("rate", rate)
             .withColumn("whole", F.floor("rate")).withColumn("part", F.col("n") * (F.col("rate") - F.col("whole"))))
    by_size = Window.partitionBy("owner").orderBy("size")
    running = written(rated.withColumn("until", F.sum("part").over(by_size)).select(
        "owner", "size", "n", "rate", "whole", "until",
        F.coalesce(F.lag("until").over(by_size), F.lit(0.0)).alias("since"), "target"), "balance")
    start = F.col("start")
    tried = running.withColumn("start", F.explode(F.array(*[F.lit((i + 0.5) / STARTS) for i in range(STARTS)])))
    extra = F.least(F.floor(F.col("until") + start) - F.floor(F.col("since") + start), F.col("n"))
    best = (tried.groupBy("owner", "start").agg(
        F.abs(F.sum((F.col("n") * F.col("whole") + extra) * F.col("size")) - F.max("target")).alias("off"))
        .groupBy("owner").agg(F.min_by("start", F.struct("off", "start")).alias("start")))
    width = F.greatest(F.lit(256.0), F.sqrt("n"))
    chosen = written(running.join(best, "owner").select(
        "owner", "size", "n", "rate", "whole", extra.alias("extra"),
        F.ceil(F.col("n") / width).alias("groups")), "balance")
    members = thin.join(chosen.where("extra > 0 AND extra < n"), ["owner", "size"]).withColumn(
        "part", F.pmod(F.xxhash64("pick"), F.col("groups")))
    group_sizes = members.groupBy("owner", "size", "extra", "n", "part").agg(F.count(F.lit(1)).alias("here"))
    until = F.sum("here").over(Window.partitionBy("owner", "size").orderBy("part"))
    quota = group_sizes.withColumn("until", until).select(
        "owner", "size", "part",
        (F.floor(F.col("until") * F.col("extra") / F.col("n"))
         - F.floor((F.col("until") - F.col("here")) * F.col("extra") / F.col("n"))).alias("quota"))
    place = F.row_number().over(Window.partitionBy("owner", "size", "part").orderBy("pick"))
    last = (members.withColumn("place", place).join(quota, ["owner", "size", "part"]).where("place <= quota")
            .groupBy("owner", "size", "part").agg(F.max("pick").alias("last")))
    last = written(last, "balance")
    decided = thin.join(chosen, ["owner", "size"]).withColumn("part", F.pmod(F.xxhash64("pick"), F.col("groups")))
    more = (F.when(F.col("extra") >= F.col("n"), 1).when(F.col("extra") <= 0, 0)
            .otherwise(F.coalesce((F.col("pick") <= F.col("last")).cast("int"), F.lit(0))))
    decided = decided.join(last, ["owner", "size", "part"], "left").select(
        *thin.columns, (F.col("whole") + more).cast("long").alias("copies"), "rate")
    return decided, goals


def balance(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken; also copies and rate."""
    thin = written(docs.select(F.col(key).alias("doc_id"), *keys(docs, key, text, source)), "sizes")
    decided, goals = _copies(thin)
    return decided.join(goals, "owner").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of docs, each as often as its copies say, with all their columns."""
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("body"), *keys(docs, key, text, source))
    decided, _ = _copies(written(body.drop("body"), "sizes"))
    copies = decided.where("copies > 0").select("owner", "size", "pick", "copies").distinct()
    return (body.join(copies, ["owner", "size", "pick"])
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("body.*"))
