"""Wide and long shapes, densified tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import only_value
from cropledger.functions.text import code_parts
from cropledger.operators.lookup import bounded, guard, over_blocks, too_many, unique_rows

# An observed list of members becomes columns; more than this is not a dimension.
MOST_COLUMNS = 2_000


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column a table lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pivot_wider(
    df: DataFrame, ids: Sequence[str], key: str, value: str, members: Sequence[str] | None = None, fill: float | None = None,
    *, also: Sequence[str] = (),
) -> DataFrame:
    """One column per member in a single shuffle; a repeated cell fails, an absent one is NULL or ``fill``.

    A row whose key is not among ``members`` fails too. Without ``members`` those that occur are taken, and those of
    ``also``, in order, at the cost of a job over the keys.
    """
    if members is None:
        seen = df.select(F.col(key).cast("string").alias("m")).distinct().limit(MOST_COLUMNS + 1).collect()
        if len(seen) > MOST_COLUMNS or any(r["m"] is None for r in seen):
            raise ValueError(f"{key} has a missing entry or more than {MOST_COLUMNS} members")
        members = sorted({*also, *(r["m"] for r in seen)})
    known = F.col(key).isin(list(members)) & F.col(key).isNotNull()
    cells = [only_value(F.col(key) == m, value, f"{key}={m}").alias(m) for m in members]
    other = F.max(F.when(~F.coalesce(known, F.lit(False)), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    wide = df.groupBy(*ids).agg(*cells, other.alias("__other"))
    message = F.concat(F.lit(f"{key} outside the listed members: "), F.col("__other"))
    wide = guard(wide, F.col("__other").isNotNull(), message).drop("__other")
    return wide if fill is None else wide.fillna(fill, list(members))


def pivot_longer(
    df: DataFrame, values: Sequence[str], key: str = "Variable", value: str = "Value"
) -> DataFrame:
    """One row per listed column; missing values stay."""
    ids = [c for c in df.columns if c not in values]
    return df.unpivot(ids, list(values), key, value)


def split_code(df: DataFrame, column: str, into: Sequence[str], *, keep: bool = False) -> DataFrame:
    """Replace a code by its parts; ``keep`` leaves the code itself in place too."""
    others = [c for c in df.columns if c not in into and (keep or c != column)]
    return df.select(*others, *code_parts(F.col(column), into))


def densify(
    df: DataFrame, dim: str, value: str, *, members: Sequence[str] | None = None, fill: float = 0.0, many: bool | None = None
) -> DataFrame:
    """Every combination of the other columns with every member of ``dim``; absent or missing cells get ``fill``.

    Members are the listed ones, or all that occur. A repeated cell fails. After the cells are proven
    unique, a combination collects at most one entry per member. ``many`` finds absent cells by blocks of members and a
    grouping instead; unless told, a job over the members decides. Told that there are few, a list past the bound fails.
    """
    keys = [c for c in df.columns if c not in (dim, value)]
    cells = unique_rows(df, [*keys, dim], [value], "table to densify")
    if members is None and (too_many(df, F.col(dim)) if many is None else many):
        own = cells.where(F.col(dim).isNotNull()).select(*keys, dim, F.coalesce(value, F.lit(fill)).alias(value))
        grid = over_blocks(cells.select(*keys).distinct(), dim, cells, F.col(dim)).withColumn(value, F.lit(fill))
        # Null-safe by grouping: a cell and its place in the grid come together, and the cell counts.
        both = own.withColumn("__own", F.lit(1)).unionByName(grid.withColumn("__own", F.lit(0)))
        return both.groupBy(*keys, dim).agg(F.max_by(value, "__own").alias(value)).select(*df.columns)
    if members is None:
        # Counting values keeps the cells whole here, so that their shuffle is shared and not computed twice.
        seen = F.struct(F.array_sort(F.collect_set(dim)).alias("members"), F.count(value).alias("known"))
        listed = bounded(cells.agg(seen).scalar()["members"], dim)
    else:
        listed = F.array(*[F.lit(m) for m in members])
    by_member = F.map_from_entries(F.collect_list(F.struct(F.col(dim), F.col(value))))
    return (
        cells.groupBy(*keys)
        .agg(by_member.alias("__cells"))
        .withColumn("__members", listed)
        .select(*keys, "__cells", F.explode("__members").alias(dim))
        .select(
            *[
                F.coalesce(F.try_element_at("__cells", F.col(dim)), F.lit(fill)).alias(value) if c == value else c
                for c in df.columns
            ]
        )
    )


def complete_grid(
    df: DataFrame, grid: DataFrame, cell: Sequence[str], value: str, facet: str | None = None, fill: float = 0.0,
    *, many: bool | None = None,
) -> DataFrame:
    """Rows of ``df`` on the cells of ``grid``, plus a ``fill`` row for every absent cell (per facet member)
    and every combination of the remaining columns. Missing values become ``fill``.

    The member lists (facet, remaining attributes) travel as one value each; with ``many`` they are met in blocks. Unless
    told, a job over the members decides. Told that there are few, a list past the bound fails.
    """
    wanted = [*cell] if facet is None else [*cell, facet]
    others = [c for c in df.columns if c not in (*wanted, value)]
    own = F.struct(*others)
    lists = ([F.col(facet)] if facet else []) + ([own] if others else [])
    many = bool(lists) and (too_many(df, *lists) if many is None else many)
    places = grid.select(*cell).distinct()
    marked = df.withColumn("__hit", F.lit(True))
    if many:
        places = over_blocks(places, facet, df, F.col(facet)) if facet else places
        joined = places.join(marked, wanted, "left")
        if others:
            absent = over_blocks(joined.where(F.col("__hit").isNull()).select(*wanted, value), "__o", df, own)
            joined = joined.where(F.col("__hit")).select(*wanted, value, own.alias("__o")).unionByName(absent)
    else:
        sets = [F.collect_set(facet).alias("members")] if facet else []
        sets += [F.collect_set(own).alias("combos")] if others else []
        if sets:
            places = places.withColumn("__seen", df.agg(F.struct(*sets)).scalar())
        if facet is not None:
            places = places.select("*", F.explode(bounded(F.col("__seen.members"), facet)).alias(facet))
        # One join finds the rows on the grid and the places without any; the latter fan out to all combinations.
        joined = places.join(marked, wanted, "left")
        if others:
            combos = bounded(F.col("__seen.combos"), "attribute combinations")
            joined = joined.withColumn("__o", F.explode(F.when(F.col("__hit"), F.array(own)).otherwise(combos)))
    filled = F.coalesce(F.col(value), F.lit(fill))
    shown = {c: F.col(f"__o.{c}") for c in others} | {value: filled}
    return joined.select(*[shown[c].alias(c) if c in shown else F.col(c) for c in df.columns])


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key combinations of ``left`` that ``right`` does not have."""
    return left.select(*keys).subtract(right.select(*keys))


def column_exprs(df: DataFrame, **exprs: Column) -> DataFrame:
    """Derived columns in order, so that a later one may use an earlier one."""
    return df.select("*", *[e.alias(name) for name, e in exprs.items()])
