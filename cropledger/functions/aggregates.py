"""Aggregates that keep a missing input visible instead of skipping it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# An exact sum cuts a number into whole multiples of 2^24, 1, 2^-24, 2^-48 and 2^-72; all but the first are below 2^24.
LIMB = 24
POWERS = [24, 0, -24, -48, -72]
LARGEST = 2.0**80


def exact_sum(value: str | Column) -> Column:
    """Sum of doubles that has the same bits in whatever order and partitions the rows come.

    Each number is cut into limbs on a fixed grid, the limbs are summed as whole numbers and put together at the end. What lies below
    2^-72 is cut off; a group that holds a number of 2^80 or more, an infinity or NaN has the ordinary sum. A group may
    have some 10^11 rows; past that the sum of a limb overflows, which fails.
    """
    value = _col(value).cast("double")
    small = F.abs(value) < LARGEST
    kept = F.when(small, value)
    limbs = []
    for k, power in enumerate(POWERS):
        # The remainder is exact, and so is the division by a power of two.
        rest = kept if k == 0 else kept % F.lit(2.0 ** POWERS[k - 1])
        limbs.append(F.sum((rest / F.lit(2.0**power)).cast("long")))
    total = None
    for k in range(len(limbs) - 1, 0, -1):
        carry = F.shiftright(limbs[k], LIMB)
        low = (limbs[k] - F.shiftleft(carry, LIMB)).cast("double") * F.lit(2.0 ** POWERS[k])
        total = low if total is None else total + low
        limbs[k - 1] = limbs[k - 1] + carry
    total = limbs[0].cast("double") * F.lit(2.0 ** POWERS[0]) + total
    return F.when(F.count(value) == F.count(kept), total).otherwise(F.sum(value))


def plain_sum(value: str | Column, exact: bool = False) -> Column:
    return exact_sum(value) if exact else F.sum(_col(value))


def strict_sum(value: str | Column, *, exact: bool = False) -> Column:
    """Sum that is NULL as soon as one row of the group is NULL; ``exact`` makes it independent of the order of rows."""
    value = _col(value)
    return F.when(F.count(value) == F.count(F.lit(1)), plain_sum(value, exact))


def strict_sum_where(condition: Column, value: str | Column) -> Column:
    """``strict_sum`` over the rows of the group that meet ``condition``; NULL if there are none."""
    kept = F.when(condition, _col(value))
    return F.when(F.count(kept) == F.count_if(condition), F.sum(kept))


def weighted_mean(value: str | Column, weight: str | Column, *, exact: bool = False) -> Column:
    """Weighted mean of a group; ``exact`` makes it independent of the order of rows.

    NULL if a weight is NULL, if a value with a non-zero weight is NULL, or if the weights
    add up to zero. Rows of zero weight never count, whatever their value.
    """
    value, weight = _col(value), _col(weight)
    counts = weight != 0
    whole = (F.count(weight) == F.count(F.lit(1))) & (F.count_if(counts & value.isNull()) == 0)
    return F.when(whole, F.try_divide(plain_sum(F.when(counts, value * weight), exact), plain_sum(weight, exact)))


def ratio_of_sums(numerator: str | Column, denominator: str | Column, *, exact: bool = False) -> Column:
    return F.try_divide(strict_sum(numerator, exact=exact), strict_sum(denominator, exact=exact))


def only_value(condition: Column, value: str | Column, what: str) -> Column:
    """The one value among the rows that meet ``condition``; fails on a second one."""
    repeated = F.raise_error(F.lit(f"more than one value for {what}"))
    return F.when(F.count_if(condition) > 1, repeated).otherwise(F.max(F.when(condition, _col(value))))
