"""Unit constants and price levels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit constants of the reported indicators.
BIOMASS_GJ_PER_T = 17.5
CARBON_MASS = 12
CO2_MASS = 44
DAYS_PER_YEAR = 365


def thousand_km2_to_thousand_ha(area: Column) -> Column:
    return area / F.lit(10.0) * F.lit(1000.0)


def thousand_km2_to_million_ha(area: Column) -> Column:
    return area / F.lit(10.0)


def ej_to_mt(energy: Column) -> Column:
    """Biomass energy to mass: EJ -> GJ -> t -> Mt."""
    return energy * F.lit(1e9) / F.lit(BIOMASS_GJ_PER_T) / F.lit(1e6)


def carbon_to_co2(mass: Column) -> Column:
    return mass * F.lit(float(CO2_MASS)) / F.lit(float(CARBON_MASS))


def per_carbon_to_per_co2(price: Column) -> Column:
    return price * F.lit(float(CARBON_MASS)) / F.lit(float(CO2_MASS))


def per_person_and_day(amount: Column, million_people: Column) -> Column:
    """Annual petacalories over a population in millions -> kcal per person and day."""
    return F.try_divide(amount / F.lit(float(DAYS_PER_YEAR)), million_people) * F.lit(1e6)


def price_ratio(levels: Mapping[int, float], to_year: int, base_year: int) -> float:
    """Factor that restates money of ``base_year`` in money of ``to_year``."""
    missing = [y for y in (to_year, base_year) if y not in levels]
    if missing:
        raise KeyError(f"no price level for {missing}")
    return levels[to_year] / levels[base_year]


def deflate(value: Column, levels: Mapping[int, float], to_year: int, base_year: int) -> Column:
    return value * F.lit(price_ratio(levels, to_year, base_year))


def price_levels(table: DataFrame, year: str = "year", level: str = "level") -> dict[int, float]:
    """Read a price-level table (one row per calendar year) into the mapping used above."""
    rows = table.groupBy(year).agg(F.max(level).alias("v"), F.min(level).alias("w")).collect()
    unclear = [r[year] for r in rows if r["v"] != r["w"]]
    if unclear:
        raise ValueError(f"several price levels for {sorted(unclear)[:5]}")
    return {int(r[year]): float(r["v"]) for r in rows}
