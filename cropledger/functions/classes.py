"""Classing of numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def class_below(value: Column, limit: float, below: str, otherwise: str) -> Column:
    return F.when(value < limit, F.lit(below)).when(value >= limit, F.lit(otherwise))


def rounded_breaks(low: Column, high: Column, n: int) -> Column:
    """Sorted distinct break points: n equal steps between the ends widened to 0.1, rounded half to even."""
    lo = F.floor(low * 10) / F.lit(10.0)
    hi = F.ceil(high * 10) / F.lit(10.0)
    points = [F.bround(lo + F.lit(float(k)) * ((hi - lo) / F.lit(float(n))), 1) for k in range(n + 1)]
    return F.array_distinct(F.array(*points))


def class_index(value: Column, breaks: Column, n: int) -> Column:
    """Number of break points below a value; ``breaks`` holds at most n + 1."""
    below = [F.coalesce((F.get(breaks, F.lit(k)) < value).cast("int"), F.lit(0)) for k in range(n + 1)]
    return reduce(lambda a, b: a + b, below)


def right_closed_label(value: Column, breaks: Column, n: int) -> Column:
    """``(a,b]`` interval of a value; at or below the first break, or above the last, there is none."""
    at = class_index(value, breaks, n)
    upper = F.get(breaks, at)
    lower = F.get(breaks, at - 1)
    text = F.concat(F.lit("("), _short(lower), F.lit(","), _short(upper), F.lit("]"))
    return F.when((at > 0) & upper.isNotNull(), text)


def _short(x: Column) -> Column:
    """Break point with one decimal, whole numbers without."""
    tenths = F.round(x * 10).cast("bigint")
    whole = F.concat(F.when(tenths < 0, F.lit("-")).otherwise(F.lit("")), F.floor(F.abs(tenths) / 10).cast("string"))
    return F.when(tenths % 10 == 0, whole).otherwise(
        F.concat(whole, F.lit("."), (F.abs(tenths) % 10).cast("string"))
    )
