"""Lookups against dimension tables and other facts.

Checks run inside the plan: a row that breaks a lookup raises when the job reaches it, so a check
costs no extra pass over the fact. The guards sit in filters, which column pruning cannot drop.
No side is broadcast by hint: Spark broadcasts a side when its own size check allows it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "__hit"
_COPIES = "__copies"
# A list of members that travels as one value may have so many entries; longer ones are met in blocks of about so many.
MOST_MEMBERS, BLOCK_MEMBERS = 100_000, 10_000

Keys = str | Sequence[str] | Mapping[str, str]


def _key_map(on: Keys) -> dict[str, str]:
    """{left column: right column}"""
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {k: k for k in on}


def _shown(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def bounded(members: Column, what: str) -> Column:
    """A list of members, or an error if it is too long to be a dimension."""
    return F.when(F.size(members) <= MOST_MEMBERS, members).otherwise(
        F.raise_error(F.lit(f"more than {MOST_MEMBERS} members: {what}"))
    )


def too_many(df: DataFrame, *members: Column) -> bool:
    """Whether one of the lists of distinct members is too long for a value, by one job over the table."""
    found = df.agg(*[F.count_distinct(m) for m in members]).first() if members else ()
    return any(n > MOST_MEMBERS for n in found)


def over_blocks(df: DataFrame, column: str, members: DataFrame, member: Column) -> DataFrame:
    """Every row once per distinct member, however many there are.

    Members lie in blocks of about ``BLOCK_MEMBERS`` by their hash. A row goes to each block by its number, an equi-join, and
    meets the members of a block as one list.
    """
    every = members.select(member.alias(column)).where(F.col(column).isNotNull()).distinct()
    n = F.greatest(F.lit(1), F.ceil(every.agg(F.count(F.lit(1))).scalar() / BLOCK_MEMBERS)).cast("int")
    blocks = every.select(F.pmod(F.xxhash64(column), n).cast("int").alias("__block"), column)
    blocks = blocks.groupBy("__block").agg(F.collect_list(column).alias("__members"))
    spread = df.withColumn("__block", F.explode(F.sequence(F.lit(0), n - 1)))
    return spread.join(blocks, "__block").withColumn(column, F.explode("__members")).drop("__block", "__members")


def guard(df: DataFrame, broken: Column, message: Column) -> DataFrame:
    """Pass all rows through, but fail the job on one for which ``broken`` holds."""
    return df.where(F.when(broken, F.raise_error(message)).otherwise(F.lit(True)))


def unique_rows(df: DataFrame, keys: Sequence[str], take: Sequence[str], what: str) -> DataFrame:
    """One row per key; fails on a key that occurs twice."""
    counted = df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in take], F.count(F.lit(1)).alias(_COPIES))
    message = F.concat(F.lit(f"{what} has a repeated key: "), _shown(keys))
    return guard(counted, F.col(_COPIES) > 1, message).drop(_COPIES)


def _right_side(dim: DataFrame, on: dict[str, str], take: Mapping[str, str], unique: bool, what: str) -> DataFrame:
    right = dim.select(
        *[F.col(r).alias(l) for l, r in on.items()],
        *[F.col(src).alias(name) for name, src in take.items()],
    )
    return right if unique else unique_rows(right, list(on), list(take), what)


def _take_map(take: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(take) if isinstance(take, Mapping) else {c: c for c in take}


def strict_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Keys,
    take: Sequence[str] | Mapping[str, str],
    *,
    unique: bool = False,
    what: str = "lookup table",
) -> DataFrame:
    """Left equi-join that must match: every left row finds exactly one right row with all attributes set.

    ``on`` maps left to right key names, ``take`` maps new column names to right columns.
    ``unique=True`` states that the right keys were checked before (see ``sources.dims``) or are
    unique by construction.
    """
    on, take = _key_map(on), _take_map(take)
    right = _right_side(dim, on, take, unique, what).withColumn(_HIT, F.lit(True))
    joined = df.join(right, list(on), "left")
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in (_HIT, *take)])
    message = F.concat(F.lit(f"no match in {what} for "), _shown(list(on)))
    return guard(joined, missing, message).drop(_HIT)


def unmatched_keys(df: DataFrame, dim: DataFrame, on: Keys) -> DataFrame:
    """Distinct left keys without a match: the report to look at after a failed strict lookup."""
    on = _key_map(on)
    right = dim.select(*[F.col(r).alias(l) for l, r in on.items()])
    return df.select(*on).distinct().join(right, list(on), "left_anti")


def strict_natural_lookup(df: DataFrame, other: DataFrame, *, unique: bool = False, what: str = "lookup table") -> DataFrame:
    """Strict lookup on all columns the two tables share."""
    shared = [c for c in df.columns if c in other.columns]
    if not shared:
        raise ValueError(f"no column shared with {what}")
    return strict_lookup(df, other, shared, [c for c in other.columns if c not in shared], unique=unique, what=what)


def lookup_default(
    df: DataFrame,
    dim: DataFrame,
    on: Keys,
    defaults: Mapping[str, object],
    *,
    unique: bool = False,
    what: str = "lookup table",
) -> DataFrame:
    """Left join; attributes that stay missing take their default."""
    on = _key_map(on)
    joined = df.join(_right_side(dim, on, {c: c for c in defaults}, unique, what), list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def lookup_matched(
    df: DataFrame,
    dim: DataFrame,
    on: Keys,
    take: Sequence[str] | Mapping[str, str],
    *,
    unique: bool = False,
    what: str = "lookup table",
) -> DataFrame:
    """Rows whose key has a non-blank attribute, with that attribute; others drop out."""
    on, take = _key_map(on), _take_map(take)
    joined = df.join(_right_side(dim, on, take, unique, what), list(on), "left")
    return joined.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in take]))


def restrict_lookup(df: DataFrame, dim: DataFrame, on: Keys, take: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Inner join: the dimension both restricts and labels the rows."""
    on, take = _key_map(on), _take_map(take)
    return df.join(_right_side(dim, on, take, True, ""), list(on), "inner")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a NULL key meets a NULL key."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}" if c in keys else c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def replicate_over(df: DataFrame, column: str, members: Sequence) -> DataFrame:
    """Every row once per member of a short list."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(m) for m in members])))


def replicate_over_observed(df: DataFrame, column: str, source: DataFrame, member: str, *, many: bool | None = None) -> DataFrame:
    """Every row once per distinct member seen in another table: carried as one value, or with ``many`` in blocks.

    Unless told, a job over the members decides. Told that there are few, a list past the bound fails.
    """
    if too_many(source, F.col(member)) if many is None else many:
        return over_blocks(df, column, source, F.col(member))
    members = source.agg(F.array_sort(F.collect_set(member))).scalar()
    return df.withColumn(column, bounded(members, member)).withColumn(column, F.explode(column))
