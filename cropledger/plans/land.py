"""Harvested area, climate effect on yields, land cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import strict_sum, weighted_mean
from cropledger.functions.text import among, recode_values
from cropledger.functions.units import thousand_km2_to_thousand_ha
from cropledger.operators.lookup import lookup_default, lookup_matched, replicate_over, strict_lookup
from cropledger.operators.reshape import pivot_wider, split_code
from cropledger.operators.rollup import append_totals, members, region_rollup, series_sum
from cropledger.plans.inputs import ModelInputs, report_rows
from cropledger.sources import fixed

CODE_PARTS = ["LandLeaf", "Basin", "IRR", "MGMT"]
ENERGY_LEAVES = fixed.AREA_ITEM["ECP"]


def split_leaf_code(df: DataFrame, column: str) -> DataFrame:
    """Leaf, basin, irrigation and management of a code.

    A missing code has a blank leaf, which no mapping knows. A leaf that cannot be NULL also spares the
    null test of the following lookup, which would be pushed down and split every code a second time.
    """
    return split_code(df, column, CODE_PARTS).withColumn("LandLeaf", F.coalesce("LandLeaf", F.lit("")))


def _harvested(m: ModelInputs, land: DataFrame, region: str) -> DataFrame:
    """Land cover times harvests per year (1 where unknown), with the leaf code split."""
    harvests = m.table("harvests").select(
        F.col("region").alias(region), F.col("technology").alias("LandLeaf"), "harvests_per_year"
    )
    cover = lookup_default(land, harvests, [region, "LandLeaf"], {"harvests_per_year": 1.0}, what="harvests")
    return split_leaf_code(cover.withColumn("value", F.col("value") * F.col("harvests_per_year")), "LandLeaf")


def area_by_code(m: ModelInputs) -> DataFrame:
    """AREA, ARRF, ARIR by item with the all-crop total, report codes only."""
    split = _harvested(m, m.report_level("Detailedland"), "region0")
    by_leaf = series_sum(split, "region", "LandLeaf", "IRR")
    labelled = lookup_matched(by_leaf, m.dims.leaves, "LandLeaf", ["item"], unique=True)
    area = labelled.withColumn("value", thousand_km2_to_thousand_ha(F.col("value")))
    by_item = series_sum(area, "region", "item", "IRR")
    rows = report_rows(
        by_item, Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"), Item=F.col("item"),
        Variable=recode_values(F.col("IRR"), {"IRR": "ARIR", "RFD": "ARRF"}), Unit="1000 ha", Value=F.col("value"),
    )
    totals = [(None, {"Variable": "AREA"}), (None, {"Item": "CRP"}), (None, {"Variable": "AREA", "Item": "CRP"})]
    return m.stage("area_by_code", append_totals(rows, totals))


def area(m: ModelInputs) -> DataFrame:
    return region_rollup(area_by_code(m))


def harvested_2015(m: ModelInputs) -> DataFrame:
    """Harvested area of the first year by native region, leaf and irrigation: the yield weights."""
    land = m.native_level("Detailedland").where(F.col("year") == m.years[0])
    summed = series_sum(_harvested(m, land, "region"), "region", "LandLeaf", "IRR")
    return summed.withColumn("value", thousand_km2_to_thousand_ha(F.col("value")))


def climate_yield_effect(m: ModelInputs) -> DataFrame:
    """YECC: percent yield change under climate change, base-area weighted, for every scenario that has it."""
    yields = m.table("exogenous_yield").where((F.col("year") % 5 == 0) & F.col("year").between(*m.years))
    compared = yields.where(F.col("scenario").isin("nocc", "rcp7p0"))
    both = pivot_wider(compared, ["region", "irr", "crop", "year"], "scenario", "value", ["nocc", "rcp7p0"])
    effect = both.withColumn("effect", (F.try_divide("rcp7p0", "nocc") - 1) * 100)
    base = harvested_2015(m).where(
        (F.col("scenario") == fixed.BASE_SCENARIO) & ~among(F.col("LandLeaf"), ENERGY_LEAVES)
    )
    weights = base.select("region", F.col("IRR").alias("irr"), F.col("LandLeaf").alias("crop"), F.col("value").alias("weight"))
    weighted = lookup_matched(effect, weights, ["region", "irr", "crop"], ["weight"], unique=True)
    labelled = lookup_matched(m.code_of(weighted), m.dims.leaves, {"crop": "LandLeaf"}, ["item"], unique=True)
    means = labelled.groupBy("Region", F.col("item").alias("Item"), F.col("year").alias("Year")).agg(
        weighted_mean("effect", "weight").alias("Value"), strict_sum("weight").alias("weight")
    )
    with_change = [s for s in m.scenarios if fixed.NO_CLIMATE_CHANGE not in s]
    rows = report_rows(replicate_over(means, "Scenario", with_change), "weight", Variable="YECC", Unit="%")
    return region_rollup(rows, weight="weight")


def land_cover_by_code(m: ModelInputs) -> DataFrame:
    land = strict_lookup(m.report_level("Aggland"), m.dims.leaves, "LandLeaf", ["cover"], unique=True, what="leaves")
    rows = report_rows(
        series_sum(land, "region", "cover"), Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"),
        Item=F.col("cover"), Variable="LAND", Unit="1000 ha", Value=thousand_km2_to_thousand_ha(F.col("value")),
    )
    return append_totals(rows, [(None, {"Item": "TOT"}), (members("Item", ["GRS", "CRP"]), {"Item": "AGR"})])


def land_cover(m: ModelInputs, *, with_energy_area: bool = True) -> DataFrame:
    """LAND by cover with TOT and AGR; the energy-crop area rows of AREA follow unless left out."""
    land = region_rollup(land_cover_by_code(m))
    if not with_energy_area:
        return land
    energy = area_by_code(m).where((F.col("Variable") == "AREA") & (F.col("Item") == "ECP"))
    return land.unionByName(region_rollup(energy))
