"""First and last rows per key.

Everything here is an aggregation whose partial step keeps one row per key and map task, so a key
that holds a large share of all rows still reaches the shuffle as a handful of rows. A ranking
window would send every row of that key to one task.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import timefmt

DAY = "_day"


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least `order` per key; rows equal in it are told apart by their other columns."""
    return _pick(df, keys, order, F.min)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` per key."""
    return _pick(df, keys, order, F.max)


def row_digest(columns: Sequence[str]) -> Column:
    """MD5 of the columns' texts: tells rows of one key and time apart by the same rule, whatever columns go on.

    It is 16 bytes wide, so a row's tie-break costs the shuffle no more than that.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("|", *texts)))


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str], identity: Sequence[str],
                   columns: Sequence[str]) -> DataFrame:
    """keys, order and `columns` of the row with the greatest `order` per key, then the greatest digest of `identity`.

    `identity` names what makes a record; those that df does not have are left out. Rows equal in all of it are one record,
    so which row stays does not depend on `columns`, as it would if these decided.
    """
    tie = row_digest([c for c in identity if c in df.columns and c not in (*keys, *order)])
    rest = [c for c in columns if c not in (*keys, *order)]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, tie.alias("_tie"), *rest)).alias("_row"))
    return picked.select(*keys, *[f"_row.{c}" for c in (*order, *rest)])


def _pick(df: DataFrame, keys, order, choose) -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, *order)]
    picked = df.groupBy(*keys).agg(choose(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def join_side(df: DataFrame, key: str, order: Sequence[str], choose=F.max) -> DataFrame:
    """One row per key as the side of a join whose other side may have hot keys.

    The key is read from the picked row instead of the grouping. So Spark does not take this side as
    partitioned by the key already and shuffles it, one row per key, once more; only a join of two
    shuffled sides can be cut by the adaptive skew-join rule.
    """
    rest = [c for c in df.columns if c not in order]
    return df.groupBy(F.col(key).alias("_by")).agg(choose(F.struct(*order, *rest)).alias("_row")).select("_row.*")


def daily_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts",), unit: str = "ms") -> DataFrame:
    """The first row per key and calendar day. keys are columns; order starts with the epoch column."""
    with_day = _with_day(df, order[0], unit)
    return first_per(with_day, [*keys, DAY], order).drop(DAY)


def daily_first_time(df: DataFrame, keys: Sequence[str], ts: str = "ts", unit: str = "ms") -> DataFrame:
    """Key, day and time of the first row per key and day; a hash aggregate over fixed-width values."""
    return _with_day(df, ts, unit).groupBy(*keys, DAY).agg(F.min(ts).alias(ts))


def flag_daily_first(df: DataFrame, keys: Sequence[str], flag: str, order: Sequence[str] = ("ts",),
                     unit: str = "ms") -> DataFrame:
    """All rows, with 1 in `flag` on the first one per key and day and 0 on the others.

    `order` must tell rows of a key apart. Null keys are keys like others. The flagged rows come back by a join on key
    and order together: those values are nearly unique, so no join partition grows with a hot key.
    """
    keyed = _with_day(df, order[0], unit)
    first = keyed.groupBy(*keys, DAY).agg(F.min(F.struct(*order)).alias("_first"))
    names = [*keys, *order]
    marks = first.select(*keys, "_first.*").select(*[F.col(c).alias(f"_{c}") for c in names], F.lit(1).alias(flag))
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])
    return df.join(marks, same, "left").select(*df.columns, F.coalesce(flag, F.lit(0)).alias(flag))


def _with_day(df: DataFrame, ts: str, unit: str) -> DataFrame:
    millis = F.col(ts) if unit == "ms" else F.col(ts) * 1000
    return df.withColumn(DAY, timefmt.day_of_millis(millis))
