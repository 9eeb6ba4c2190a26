"""Grouped sums, totals and regional roll-ups.

Totals are appended in one pass: each row fans out to itself and to the totals it belongs to, and a
single aggregation sums all of them. Spark pre-aggregates on the map side, so a hot total (the world
takes every row) reaches a reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import plain_sum, strict_sum, weighted_mean
from cropledger.operators.lookup import guard

# Report codes summed into larger regions; the world takes every row.
WORLD = "WLD"
SUPER_REGIONS = {
    "NAM": ["CAN", "USA"],
    "OAM": ["BRA", "OSA"],
    "AME": ["MEN", "SSA"],
    "SAS": ["CHN", "IND", "SEA", "OAS"],
}

_OWN = "__own"
_TO = "__to"


def grouped_sum(
    df: DataFrame, by: Sequence[str | Column], value: str = "value", *, strict: bool = True, exact: bool = False
) -> DataFrame:
    """Sum over the given columns; an entry may rename, compute or add a constant. ``exact`` sums have equal bits in any order of rows."""
    total = strict_sum(value, exact=exact) if strict else plain_sum(value, exact)
    return df.groupBy(*by).agg(total.alias(value))


def series_sum(df: DataFrame, *dims: str | Column, value: str = "value", exact: bool = False) -> DataFrame:
    """``grouped_sum`` over scenario, the given dimensions and year."""
    return grouped_sum(df, ["scenario", *dims, "year"], value, exact=exact)


def sum_all_but(df: DataFrame, *left_out: str, value: str = "Value", exact: bool = False) -> DataFrame:
    """Sum over every column except the value and the ones left out."""
    return grouped_sum(df, [c for c in df.columns if c != value and c not in left_out], value, exact=exact)


Total = tuple[str | None, Mapping[str, str]]


def _target(own: bool, swapped: Sequence[str], labels: Mapping[str, str]) -> str:
    fields = [f"{str(own).lower()} AS {_OWN}"]
    fields += [f"{_quoted(labels[d])} AS `{d}`" if d in labels else f"`{d}`" for d in swapped]
    return f"struct({', '.join(fields)})"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def members(column: str, values: Sequence[str]) -> str:
    """SQL condition for membership in a short list."""
    return f"`{column}` IN ({', '.join(_quoted(v) for v in values)})"


def fan_out_totals(
    df: DataFrame, totals: Sequence[Total], measures: Mapping[str, Column], *, keep: Sequence[str] | None = None
) -> DataFrame:
    """Append totals to a table that has one row per key.

    Each total is (SQL condition for the rows it takes, or None for all, {dimension: label it overwrites}).
    ``measures`` gives the aggregate of each summed column. Own rows pass through unchanged; a second own
    row for a key fails the job. ``keep`` names the measure columns that stay in the result.
    """
    kept = list(measures) if keep is None else list(keep)
    swapped = sorted({d for _, labels in totals for d in labels})
    columns = df.columns
    keys = [c for c in columns if c not in measures]

    targets = [_target(True, swapped, {})]
    for condition, labels in totals:
        to = _target(False, swapped, labels)
        targets.append(to if condition is None else f"CASE WHEN {condition} THEN {to} END")
    spread = df.selectExpr("*", f"explode(array({', '.join(targets)})) AS {_TO}").where(f"{_TO} IS NOT NULL")
    spread = spread.selectExpr(*[f"{_TO}.`{c}`" if c in swapped else f"`{c}`" for c in columns], f"{_TO}.{_OWN}")

    own = F.col(_OWN)
    repeated = F.raise_error(F.lit(f"repeated rows for one key of {keys}"))
    alone = F.count(F.lit(1)) == 1
    values = [
        F.when(~own, agg).when(alone, F.max(c)).otherwise(repeated).alias(c) for c, agg in measures.items() if c in kept
    ]
    return spread.groupBy(*keys, _OWN).agg(*values).drop(_OWN)


def append_totals(
    df: DataFrame,
    totals: Sequence[Total],
    value: str | Sequence[str] = "Value",
    *,
    exact: bool = False,
) -> DataFrame:
    """Append strict sums; the table must have one row per key."""
    values = [value] if isinstance(value, str) else list(value)
    return fan_out_totals(df, totals, {v: strict_sum(v, exact=exact) for v in values})


def append_total(
    df: DataFrame, dim: str, label: str, value: str = "Value", where: str | None = None, *, exact: bool = False
) -> DataFrame:
    """Append one total (or subset total) member of a dimension."""
    return append_totals(df, [(where, {dim: label})], value, exact=exact)


def _region_totals(region: str, world: str, groups: Mapping[str, Sequence[str]]):
    return [(None, {region: world})] + [
        (members(region, inside), {region: code}) for code, inside in groups.items()
    ]


def region_rollup(
    df: DataFrame,
    *,
    value: str = "Value",
    weight: str | None = None,
    region: str = "Region",
    world: str = WORLD,
    groups: Mapping[str, Sequence[str]] = SUPER_REGIONS,
    repeated_rows: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Append the world and the larger regions; input rows pass through unchanged, the weight drops out.

    Without ``weight`` the appended rows are strict sums, else weighted means. The input must not hold
    a rolled-up region already. ``repeated_rows=True`` also accepts several rows per key.
    """
    codes = [world, *groups]
    bad = F.concat(F.lit("already rolled up: "), F.col(region))
    df = guard(df, F.col(region).isin(codes), bad)
    mean = strict_sum(value, exact=exact) if weight is None else weighted_mean(value, weight, exact=exact)
    totals = _region_totals(region, world, groups)
    if not repeated_rows:
        measures = {value: mean} if weight is None else {value: mean, weight: F.sum(weight)}
        return fan_out_totals(df, totals, measures, keep=[value]).select(*[c for c in df.columns if c != weight])

    columns = [c for c in df.columns if c != weight]
    labels = [f"'{to[region]}'" if cond is None else f"CASE WHEN {cond} THEN '{to[region]}' END" for cond, to in totals]
    spread = df.withColumn(region, F.expr(f"explode(array({', '.join(labels)}))")).where(F.col(region).isNotNull())
    rolled = spread.groupBy(*[c for c in columns if c != value]).agg(mean.alias(value))
    return rolled.select(*columns).unionByName(df.select(*columns))
