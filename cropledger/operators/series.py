"""Annual series: change, index, freeze, fill, cumulate.

Base values come from an aggregate joined back, not from a window over raw rows, so a key with very
many rows is combined on the map side and its join side can be split. Base years are picked inside the
aggregate and not by a filter: both sides of the join then share one computation of an aggregated input.
Windows run only over rows proven unique per (key, year): a partition holds one row per calendar year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropledger.functions.aggregates import only_value
from cropledger.operators.lookup import guard, join_null_safe, unique_rows


def _others(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]


def change_from_first(
    df: DataFrame, by: Sequence[str], order: str, value: str, kind: str = "ratio", into: str | None = None
) -> DataFrame:
    """Value over, or minus, the value of the first ``order`` entry of its series."""
    if kind not in ("ratio", "abs"):
        raise ValueError(kind)
    first = df.groupBy(*by).agg(F.min_by(value, order).alias("__base"))
    base, own = F.col("__base"), F.col(value)
    change = F.try_divide(own, base) if kind == "ratio" else own - base
    return join_null_safe(df, first, by).withColumn(into or value, change).drop("__base")


def index_to_year(df: DataFrame, by: Sequence[str], year: str, value: str, base: int, into: str | None = None) -> DataFrame:
    """Value over the value of the base year of its series; two rows in that year fail."""
    at_base = df.groupBy(*by).agg(only_value(F.col(year) == base, value, f"{year}={base}").alias("__base"))
    return (
        join_null_safe(df, at_base, by)
        .withColumn(into or value, F.try_divide(F.col(value), F.col("__base")))
        .drop("__base")
    )


def freeze_at(
    df: DataFrame, by: Sequence[str], year: str, value: str, rules: Sequence[tuple[Column | None, int]], into: str | None = None
) -> DataFrame:
    """Every year takes the value of a base year; the first rule whose condition holds names that year.

    Two rows of a series in a base year fail.
    """
    bases = sorted({y for _, y in rules})
    frozen = df.groupBy(*by).agg(*[only_value(F.col(year) == y, value, f"{year}={y}").alias(f"__at_{y}") for y in bases])
    choice = F.lit(None)
    for condition, y in reversed(list(rules)):
        at = F.col(f"__at_{y}")
        choice = at if condition is None else F.when(condition, at).otherwise(choice)
    joined = join_null_safe(df, frozen, by)
    return joined.withColumn(into or value, choice).drop(*[f"__at_{y}" for y in bases])


def _span(cells: DataFrame, year: str, value: str) -> Column:
    """First and last year of the whole table and the years inside that no row has, as one scalar.

    It counts values too, so that nothing is pruned from ``cells`` here and their shuffle is shared with
    the rows themselves instead of being computed twice.
    """
    first, last = F.min(year), F.max(year)
    missing = F.array_except(F.sequence(first, last), F.collect_set(year))
    return cells.agg(
        F.struct(first.alias("first"), last.alias("last"), missing.alias("missing"), F.count(value).alias("known"))
    ).scalar()


def _filled(df: DataFrame, year: str, value: str) -> DataFrame:
    """The filled series with the table's first year as ``__first``."""
    keys = _others(df, year, value)
    cells = unique_rows(df.withColumn(year, F.col(year).cast("int")), [*keys, year], [value], "annual table")
    own = F.struct(F.col(year).alias("y"), F.col(value).alias("v"))
    added = F.transform("__span.missing", lambda y: F.struct(y.alias("y"), F.lit(None).cast("double").alias("v")))
    points = (
        cells.withColumn("__span", _span(cells, year, value))
        .withColumn("__p", F.when(F.col(year) == F.col("__span.last"), F.concat(F.array(own), added)).otherwise(F.array(own)))
        .select(*keys, F.col("__span.first").alias("__first"), F.explode("__p").alias("__p"))
        .select(*keys, "__first", F.col("__p.y").alias(year), F.col("__p.v").alias(value))
    )
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(year).alias("y"), F.col(value).alias("v")))
    series = Window.partitionBy(*keys).orderBy(year)
    before = F.last(known, ignorenulls=True).over(series.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(known, ignorenulls=True).over(series.rowsBetween(0, Window.unboundedFollowing))
    b, a = F.col("__b"), F.col("__a")
    between = b["v"] + (a["v"] - b["v"]) * ((F.col(year) - b["y"]) / (a["y"] - b["y"]))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(b.isNull(), a["v"]).when(a.isNull(), b["v"]).otherwise(between)
    return points.withColumn("__b", before).withColumn("__a", after).withColumn(value, filled).drop("__a", "__b")


def fill_annual(df: DataFrame, year: str = "year", value: str = "value") -> DataFrame:
    """Add the years no row of the table has to every series that reaches the last year, and interpolate.

    A series is a combination of all other columns. Missing values are linear between the nearest known
    years and flat beyond them. A year that exists elsewhere is not added to a series that lacks it.
    """
    return _filled(df, year, value).select(*df.columns)


def cumulate(df: DataFrame, start: int = 2020, step: int = 5, year: str = "year", value: str = "value") -> DataFrame:
    """Annual fill, then the running sum from ``start`` (included), sampled every ``step`` years of the table's span."""
    keys = _others(df, year, value)
    filled = guard(_filled(df, year, value), F.col("__first") > start, F.lit(f"the data start after {start}"))
    running = Window.partitionBy(*keys).orderBy(year).rowsBetween(Window.unboundedPreceding, 0)
    return (
        filled.where(F.col(year) >= start)
        .withColumn(value, F.sum(value).over(running))
        .where((F.col(year) - F.col("__first")) % step == 0)
        .select(*df.columns)
    )
