"""Row-level measures that the metrics later sum."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Exam score buckets, each with the bound its scores stay under.
SCORE_BUCKETS = {"[0,60)": 60, "[60,70)": 70, "[70,80)": 80, "[80,90)": 90}
SCORE_TOP, SCORE_MAX = "[90,100]", 100


def score_bucket(score: Column) -> Column:
    """Label of the bucket a score falls in, empty text above the highest score."""
    label = F.when(score < 0, "[0,60)")
    for name, under in SCORE_BUCKETS.items():
        label = label.when(score < under, name)
    return label.when(score <= SCORE_MAX, SCORE_TOP).otherwise("")


def indicator(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, 1).otherwise(0)


# Sums of amounts have all the digits a decimal can have: a total does not overflow with the number of rows.
SUM = "decimal(38,2)"


def money(amount: Column) -> Column:
    """An amount of two decimals; a text or number that is none is null."""
    return amount.try_cast("decimal(18,2)")
