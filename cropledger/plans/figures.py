"""The tables behind the figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import weighted_mean
from cropledger.functions.classes import class_below, right_closed_label, rounded_breaks
from cropledger.operators.access import conform_scenario, in_years
from cropledger.operators.reshape import complete_grid, pivot_wider
from cropledger.operators.rollup import WORLD, sum_all_but
from cropledger.operators.series import change_from_first, cumulate, index_to_year
from cropledger.plans import balance, emissions, food, labour, land, resources, yields
from cropledger.plans.inputs import ModelInputs

# Years, items and limits the figures show.
SNAPSHOT = [2015, 2020, 2050]
YIELD_SNAPSHOT = [2015, 2020, 2025, 2050]
SUPPLY_USE = ["FOOD", "FEED", "PROD", "OTHR", "EXPO"]
KEY_ITEMS = ["RUM", "NRM", "DRY", "WHT", "OSD", "SGC", "VFN", "CGR"]
SHOWN_REGIONS = ["WLD", "SSA", "USA"]
MITIGATION_BELOW_GT = 1000.0


def _snapshot(df: DataFrame, years: Sequence[int], scale: float = 1.0) -> DataFrame:
    """World rows of some years, scaled, with the year as text."""
    rows = df.where((F.col("Region") == WORLD) & F.col("Year").isin(list(years)))
    return rows.withColumns({"Value": F.col("Value") / scale, "Year": F.col("Year").cast("string")})


def area_snapshot(m: ModelInputs) -> DataFrame:
    return _snapshot(land.area(m).where(F.col("Variable") == "AREA"), SNAPSHOT, 1000.0)


def land_snapshot(m: ModelInputs) -> DataFrame:
    return _snapshot(land.land_cover(m).where(~F.col("Item").isin("TOT", "NLD")), SNAPSHOT, 1000.0)


def yield_snapshot(m: ModelInputs) -> DataFrame:
    return _snapshot(yields.crop_yield(m).where(F.col("Variable") == "YILD"), YIELD_SNAPSHOT)


def supply_use_grid(m: ModelInputs) -> DataFrame:
    rows = balance.quantities(m).where(F.col("Variable").isin(SUPPLY_USE) & F.col("Item").isin(KEY_ITEMS))
    return _snapshot(rows, [2020, 2050], 1000.0)


def price_index(m: ModelInputs, base: int = 2020) -> DataFrame:
    """World producer prices relative to the base year, one column per fifth year and any other that occurs."""
    world = balance.producer_price(m).where((F.col("Region") == WORLD) & (F.col("Variable") == "XPRP"))
    ids = [c for c in world.columns if c not in ("Year", "Value")]
    index = index_to_year(world, ids, "Year", "Value", base).withColumn("Year", F.col("Year").cast("string"))
    return pivot_wider(index, ids, "Year", "Value", also=[str(y) for y in range(m.years[0], m.years[1] + 1, 5)])


def average_price(m: ModelInputs) -> DataFrame:
    """Producer price over regions and items, production weighted."""
    priced = balance.producer_price_by_code(m, balance.PRICED).where(F.col("Value").isNotNull())
    return priced.groupBy("Scenario", "Year", "Variable", "Unit").agg(weighted_mean("Value", "weight").alias("Value"))


def prices_by_item(m: ModelInputs) -> DataFrame:
    return balance.producer_price_by_code(m).withColumnRenamed("weight", "PROD")


def calories_2050(m: ModelInputs) -> DataFrame:
    return food.calories(m).where(
        (F.col("Year") == 2050) & ~F.col("Item").isin("AGR", "CRP", "LSP") & F.col("Region").isin(SHOWN_REGIONS)
    )


def wage_index(m: ModelInputs) -> DataFrame:
    """Wage relative to the first year of its series, as ``Index``."""
    wages = labour.wage(m)
    return change_from_first(wages, [c for c in wages.columns if c not in ("Year", "Value")], "Year", "Value", into="Index")


def employment_share_shown(m: ModelInputs) -> DataFrame:
    return labour.employment_share(m).where(F.col("Region").isin(SHOWN_REGIONS))


def carbon_price_from_2025(m: ModelInputs) -> DataFrame:
    return emissions.carbon_price(m).where(F.col("Year") >= 2025)


def _world_series(df: DataFrame) -> DataFrame:
    """Sum over regions as an annual series with lower-case year and value."""
    summed = sum_all_but(df.drop("Region"))
    return summed.withColumnRenamed("Year", "year").withColumnRenamed("Value", "value")


def annual_co2(m: ModelInputs) -> DataFrame:
    """Gt by scenario and year."""
    return _world_series(emissions.co2_by_code(m)).withColumn("value", F.col("value") / 1000)


def _cumulative_2050(df: DataFrame) -> DataFrame:
    """Cumulative 2020 to 2050, in thousands of the unit."""
    total = cumulate(_world_series(df)).where(F.col("year") == 2050)
    return total.withColumn("value", F.col("value") / 1000)


def cumulative_co2(m: ModelInputs) -> DataFrame:
    total = _cumulative_2050(emissions.co2_by_code(m))
    return total.withColumn("ss", class_below(F.col("value"), MITIGATION_BELOW_GT, "Mitigation", "No Policy"))


def cumulative_land_use_co2(m: ModelInputs) -> DataFrame:
    return _cumulative_2050(emissions.land_use_co2_by_code(m)).where(F.col("value") < MITIGATION_BELOW_GT)


def cumulative_farm_gases(m: ModelInputs) -> DataFrame:
    rows = emissions.farm_gases_by_code(m)
    return _cumulative_2050(rows.where(F.col("Item").isin("LSP", "CRP") & (F.col("Variable") == "EMIS")))


def cumulative_water(m: ModelInputs) -> DataFrame:
    return _cumulative_2050(resources.water_by_code(m).where(F.col("Item") == "CRP"))


def cumulative_fertiliser(m: ModelInputs) -> DataFrame:
    return _cumulative_2050(resources.fertiliser_by_code(m).where(F.col("Item") == "CRP"))


def temperature_2050(m: ModelInputs) -> DataFrame:
    """Mean temperature of the last year by conformed scenario."""
    return conform_scenario(m.in_years("MeanTemp"), m.scenarios).where(F.col("year") == 2050)


def forcing_2050(m: ModelInputs) -> DataFrame:
    """Total forcing of the last year, scenario labels as they are."""
    return in_years(m.table("ForcingTotal"), (2050, 2050))


def basin_map(df: DataFrame, grid: DataFrame, facet: str | None = None, breaks: int | None = None) -> DataFrame:
    """Values on every (region, basin) of the map, absent places 0; classed into ``breaks`` intervals on request."""
    full = complete_grid(df, grid, ["region", "basin"], "value", facet)
    if breaks is None:
        return full
    edges = full.agg(rounded_breaks(F.min("value"), F.max("value"), breaks)).scalar()
    return full.withColumn("__edges", edges).withColumn("value", right_closed_label(F.col("value"), F.col("__edges"), breaks)).drop("__edges")
