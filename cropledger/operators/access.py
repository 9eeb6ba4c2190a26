"""Reading a query table the way the indicators want it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.operators.lookup import strict_lookup

FIRST_YEAR, LAST_YEAR = 2015, 2050


def in_years(df: DataFrame, years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR), year: str = "year") -> DataFrame:
    return df.where(F.col(year).between(*years))


def conform_scenario(df: DataFrame, scenarios: Sequence[str], column: str = "scenario") -> DataFrame:
    """Labels outside the scenario list become NULL."""
    return df.withColumn(column, F.when(F.col(column).isin(list(scenarios)), F.col(column)))


def scenario_order(scenarios: Sequence[str], column: str = "scenario") -> Column:
    """Position in the scenario list, for sorting."""
    place = F.array_position(F.array(*[F.lit(s) for s in scenarios]), F.col(column))
    return F.when(place > 0, place).cast("int")


def to_report_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Keep the native region as ``region0`` and attach the report code as ``region``."""
    renamed = df.withColumnRenamed("region", "region0")
    return strict_lookup(renamed, regions, {"region0": "region"}, {"region": "code"}, unique=True, what="regions")


def pluck(
    df: DataFrame,
    scenarios: Sequence[str],
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
    *,
    regions: DataFrame | None = None,
    branch: str | None = None,
) -> DataFrame:
    """Projection years, conformed scenario, no source tag; report regions or a branch label on request."""
    df = conform_scenario(in_years(df.drop("ss", "version", "scen"), years), scenarios)
    if regions is not None:
        df = to_report_region(df, regions)
    return df if branch is None else df.withColumn("branch", F.lit(branch))


def optional_filter(df: DataFrame, column: str, members: Sequence | None) -> DataFrame:
    """Restrict to members; no list means no restriction."""
    return df if members is None else df.where(F.col(column).isin(list(members)))
