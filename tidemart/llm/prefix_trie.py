"""Prefix trie of conversations: what they share from the first turn on, by hashing blocks of BLOCK turns.

Conversations are grouped by the digests of their successive blocks first: all that agree on the blocks before make a
group. Where all members of a group go on with one and the same block, one of them stands for all, and only its turns
become nodes. Where they diverge, the turns of this one block are looked at for each member, to find the turn at which
they part. So copies and long common openings cost a block each, not a turn each.

The key of a prefix is the exclusive or of two 64-bit hashes of its (position, turn) pairs: it can be taken over blocks,
runs of blocks and turns in any order, so no conversation has to be read in sequence by one task. Sums over subtrees
need no walk through levels either. Each node is owned by its smallest member, and what one conversation owns is one
path that ends with its last turn. So the distinct turns below a node are the paths owned by its members, and every sum
over a subtree is a sum over the members of the node, which partial aggregation takes before the shuffle.

The members that end in a node are hashed in ascending order: they come as sorted runs of ids, and a task reads them one
after the other, keeping only the state of the hash.

Turns are ordered by turn number, null first, then role and text; equal rows are turns of their own. A null role or text is
empty. Rows without a conv_id belong to no conversation and make no node. An empty table has no node, not even the root.
Columns other than the four named are not read. Prefixes are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BLOCK = 4
RUN_OF_BLOCKS = 1024
ID_BITS = 12


def numbered(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, position, digest, chars), one row per turn; positions count from 1. Written, so that all steps see one order.

    Turns are sorted over the whole table, so a conversation of any length spreads over many tasks; where one goes on in
    another part, the lengths of the parts before are added.
    """
    spark = turns.sparkSession
    named = turns.select(F.col(f"`{key}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                         F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).where("conv is not null")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16)
    sorted_ = (named.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
               .sortWithinPartitions(*order)
               .select("conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
                       digest.alias("digest"), F.char_length("text").cast("long").alias("chars")))
    sorted_ = written(sorted_, "turns")
    pieces = sorted_.groupBy("conv", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("conv", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return written(sorted_.join(starts, ["conv", "part"]).select(
        "conv", (F.col("place") + F.col("shift")).alias("position"), "digest", "chars"), "turns")


def replanted(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the first turns of another one: rows as `numbered` gives them, and all conv ids.

    base and head are of column conv: conversation conv becomes the first `head` (at most `most`) turns of conversation
    `base`, then its own turns after its first `head`.
    """
    lengths = written(turns.groupBy("conv").agg(F.max("position").alias("n")), "turns")
    plans = lengths.select("conv", base.alias("base"), head.cast("long").alias("head"))
    heads = turns.where(F.col("position") <= most).withColumnRenamed("conv", "base")
    inherited = heads.join(plans, "base").where("position <= head").select("conv", "position", "digest", "chars")
    of_base = lengths.select(F.col("conv").alias("base"), F.least("n", F.lit(most)).alias("n"))
    own = (turns.withColumns({"base": base, "head": head.cast("long")}).where("position > head").join(of_base, "base", "left")
           .select("conv", (F.col("position") - F.col("head") + F.least("head", F.coalesce("n", F.lit(0)))).alias("position"),
                   "digest", "chars"))
    return written(inherited.unionByName(own), "turns"), lengths.select("conv")


def _xor(column: str) -> Column:
    return F.expr(f"bit_xor({column})")


def _marks(turns: DataFrame) -> DataFrame:
    return turns.withColumns({
        "block": F.floor((F.col("position") - 1) / BLOCK),
        "a": F.xxhash64(F.lit(1), "position", "digest"), "b": F.xxhash64(F.lit(2), "position", "digest")})


def _blocks(marked: DataFrame) -> DataFrame:
    """Per conversation and block: key and characters before the block (pa, pb, before) and key after it (a, b)."""
    own = marked.groupBy("conv", "block").agg(
        _xor("a").alias("a"), _xor("b").alias("b"), F.sum("chars").alias("chars"), F.max("position").alias("last"))
    own = written(own.withColumn("run", F.floor(F.col("block") / RUN_OF_BLOCKS)), "blocks")
    runs = own.groupBy("conv", "run").agg(_xor("a").alias("a"), _xor("b").alias("b"), F.sum("chars").alias("chars"))

    def earlier(*keys: str, order: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    zero, w = F.lit(0).cast("long"), earlier("conv", order="run")
    runs = runs.select("conv", "run", F.coalesce(_xor("a").over(w), zero).alias("ra"), F.coalesce(_xor("b").over(w), zero).alias("rb"),
                       F.coalesce(F.sum("chars").over(w), zero).alias("rc"))
    w = earlier("conv", "run", order="block")
    out = own.join(runs, ["conv", "run"]).withColumns({
        "pa": F.coalesce(_xor("a").over(w), zero).bitwiseXOR(F.col("ra")), "pb": F.coalesce(_xor("b").over(w), zero).bitwiseXOR(F.col("rb")),
        "before": F.coalesce(F.sum("chars").over(w), zero) + F.col("rc")})
    return written(out.select("conv", "block", "pa", "pb", "before", F.col("a").bitwiseXOR(F.col("pa")).alias("a"),
                              F.col("b").bitwiseXOR(F.col("pb")).alias("b"), "chars", "last"), "blocks")


GROUP = ["block", "pa", "pb"]
NODE = ["depth", "a", "b"]


def _refined(marked: DataFrame, blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """The turns that become nodes, with key and parent's key: of a group that goes on alike those of its smallest member
    (members: the group's count), of one that diverges those of every member (members: 1)."""
    alike = groups.where("lo = hi").select(F.col("least").alias("conv"), *GROUP, "members", F.lit(True).alias("alike"))
    parted = groups.where("lo <> hi")
    # The first block has one group for all conversations; asked for by a join, it would be one key for all rows.
    first = blocks.where("block = 0") if parted.where("block = 0").head(1) else blocks.limit(0)
    rest = blocks.where("block > 0").join(parted.where("block > 0").select(*GROUP), GROUP)
    every = first.unionByName(rest.select(*first.columns)).select(
        "conv", *GROUP, F.lit(1).cast("long").alias("members"), F.lit(False).alias("alike"))
    before = blocks.select("conv", "block", "before")
    chosen = alike.unionByName(every).join(before, ["conv", "block"])
    turns = marked.select("conv", "block", F.col("position").alias("depth"), "chars", F.col("a").alias("ta"), F.col("b").alias("tb"))
    w = Window.partitionBy("conv", "block").orderBy("depth")
    found = turns.join(chosen, ["conv", "block"]).withColumns({
        "a": _xor("ta").over(w).bitwiseXOR(F.col("pa")), "b": _xor("tb").over(w).bitwiseXOR(F.col("pb")),
        "ahead": F.col("before") + F.sum("chars").over(w) - F.col("chars")})
    return written(found.select(
        "conv", *GROUP, "members", "alike", *NODE, "chars", "ahead",
        F.col("a").bitwiseXOR(F.col("ta")).alias("ua"), F.col("b").bitwiseXOR(F.col("tb")).alias("ub")), "nodes")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, a, b, ids) sorted by node and run in; SHA-256 of the joined ids per node out."""
    at, state, n = None, None, 0
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n_ends", pa.int64()), ("ends_sha256", pa.string())])

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 5, schema)], schema=schema)

    for batch in batches:
        done = []
        for depth, a, b, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if at != (depth, a, b):
                if at is not None:
                    done.append((*at, n, state.hexdigest()))
                at, state, n = (depth, a, b), hashlib.sha256(ids.encode()), count
            else:
                state.update(f",{ids}".encode())
                n += count
        yield out(done)
    if at is not None:
        yield out([(*at, n, state.hexdigest())])


def _ends(finals: DataFrame) -> DataFrame:
    """Per node in which conversations end: how many, and the digest of their ids in ascending order.

    Ids come in runs of 2^ID_BITS possible values, each sorted by itself; the task of a node reads its runs in order.
    """
    run = F.shiftright("conv", ID_BITS)
    runs = finals.groupBy(*NODE, run.alias("run")).agg(F.sort_array(F.collect_list("conv")).alias("ids")).select(
        *NODE, "run", F.size("ids").cast("long").alias("n"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    parts = int(finals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (runs.repartition(parts, *NODE).sortWithinPartitions(*NODE, "run").select(*NODE, "n", "ids")
            .mapInArrow(_digest, "depth long, a long, b long, n_ends long, ends_sha256 string"))


def build(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_ends.

    turns: conv, position (1, 2, ... without gaps), digest, chars; ids: all conversations (conv), those without turns
    included (default: those that have turns). saved_tokens counts code points.
    """
    ids = turns.select("conv").distinct() if ids is None else ids
    marked = _marks(turns)
    blocks = _blocks(marked)
    key = F.struct("a", "b")
    groups = written(blocks.groupBy(*GROUP).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.min("conv").alias("least"), F.count(F.lit(1)).alias("members")), "groups")
    rows = _refined(marked, blocks, groups)
    last = blocks.groupBy("conv").agg(F.max_by(F.struct(F.col("last").alias("depth"), "a", "b"), "block").alias("end"),
                                      F.sum("chars").alias("total"))
    zero = F.lit(0).cast("long")
    finals = written(ids.join(last, "conv", "left").select(
        "conv", *[F.coalesce(F.col(f"end.{c}"), zero).alias(c) for c in NODE], F.coalesce("total", zero).alias("total")), "ends")
    ends = written(_ends(finals), "ends")

    # What each conversation owns: the nodes of which it is the smallest member.
    nodes = rows.groupBy(*NODE).agg(F.sum("members").alias("n"), F.min("conv").alias("conv"), F.max("chars").alias("chars"))
    owned = nodes.join(ends, NODE, "left").groupBy("conv").agg(
        F.sum("chars").alias("owned"), F.max(F.when(F.col("n") == F.col("n_ends"), 1).otherwise(0)).cast("long").alias("leaf"))
    own = written(finals.select("conv", "total").join(owned, "conv", "left").select(
        "conv", "total", F.coalesce("owned", zero).alias("owned"), F.coalesce("leaf", zero).alias("leaf")), "owned")

    # Sums over the members of each node: those of a group that goes on alike are added up for the group.
    def sums(each: tuple[Column, ...]) -> list[Column]:
        names = ("total", "owned", "leaf")
        return [F.sum(c).alias(n) for c, n in zip(each, names)]

    alone = rows.where("not alike").join(own, "conv").withColumn("first", F.struct("total", "owned"))
    grouped = blocks.select("conv", *GROUP).join(own, "conv").groupBy(*GROUP).agg(
        *sums((F.col("total"), F.col("owned"), F.col("leaf"))), F.min_by(F.struct("total", "owned"), "conv").alias("first"))
    together = rows.where("alike").join(grouped, GROUP)
    members = alone.unionByName(together.select(*alone.columns)).groupBy(*NODE).agg(
        F.sum("members").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("chars").alias("chars"), F.max("ahead").alias("ahead"),
        F.max("ua").alias("ua"), F.max("ub").alias("ub"), *sums((F.col("total"), F.col("owned"), F.col("leaf"))),
        F.min_by("first", "conv").alias("first"))
    rest = F.col("total") - F.col("n_convs") * F.col("ahead")
    distinct = F.col("owned") - F.col("first.owned") + F.col("first.total") - F.col("ahead")
    nodes = written(members.select(
        *NODE, "conv_id", "n_convs", "ua", "ub", F.col("leaf").alias("n_leaves"), (rest - distinct).alias("saved_tokens")), "nodes")
    top = own.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("leaf").alias("n_leaves"),
                  F.sum(F.col("total") - F.col("owned")).alias("saved_tokens")).where("n_convs > 0")
    root = top.select(*[zero.alias(c) for c in NODE], "conv_id", "n_convs", *[F.lit(None).cast("long").alias(c) for c in ("ua", "ub")],
                      F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens")
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    every = nodes.unionByName(root)
    parents = every.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("ua"), F.col("b").alias("ub"),
                           F.col("conv_id").alias("parent_conv_id"))
    return (every.join(parents, ["depth", "ua", "ub"], "left").join(kids, NODE, "left").join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.coalesce("n_ends", zero).alias("n_ends")))
