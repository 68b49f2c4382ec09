"""Aggregates written once: guarded ratios and conditional sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """Double division; a zero or NULL denominator gives NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def share_pct(num: Column, den: Column) -> Column:
    return ratio(num.cast("double") * 100.0, den)


def sum_if(cond: Column, value: Column) -> Column:
    """Sum over the rows where ``cond`` holds; NULL when there are none."""
    return F.sum(F.when(cond, value))


def sum_or_zero(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(0))


def millions(amount: Column) -> Column:
    return amount.cast("double") / 1e6


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))
