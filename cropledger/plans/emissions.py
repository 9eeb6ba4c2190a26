"""Carbon price and emissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import strict_sum, strict_sum_where
from cropledger.functions.text import matches
from cropledger.functions.units import carbon_to_co2, per_carbon_to_per_co2
from cropledger.operators.lookup import lookup_default, strict_lookup
from cropledger.operators.reshape import densify, union_all
from cropledger.operators.rollup import WORLD, append_totals, members, region_rollup, series_sum
from cropledger.plans.inputs import ModelInputs, report_rows
from cropledger.sources import fixed

# The market whose price is reported, residual and land-use sectors, farm gas labels.
PRICE_MARKET = "USACO2"
RESIDUAL = "Resource production"
LAND_USE = "LULUCF"
FARM_GASES = {"CH4_AGR": "ECH4", "CH4_AWB": "ECH4", "N2O_AGR": "EN2O", "N2O_AWB": "EN2O", "CH4": "CH4_En", "N2O": "N2O_En"}
CARBON = ["CO2", "CO2_FUG"]
UNMANAGED = "UnmanagedLand"
LIVESTOCK = ["RUM", "NRM", "DRY"]


def carbon_price(m: ModelInputs) -> DataFrame:
    """CTAX, with zeros for scenarios without a price."""
    priced = m.in_years("CO2Price").where(F.col("market") == PRICE_MARKET)
    rows = report_rows(
        priced, Scenario=F.col("scenario"), Region=WORLD, Item="TOT", Variable="CTAX", Year=F.col("year"),
        Unit="2015 USD/tCO2e", Value=m.money(per_carbon_to_per_co2(F.col("value")), 2015, 1990),
    )
    return densify(rows, "Scenario", "Value", members=list(m.scenarios))


def by_sector(m: ModelInputs) -> DataFrame:
    """All emissions by region, gas, unit and sector.

    The residual of the regional total over its sectors is a sector of its own, land-use change another.
    Each table is read once: a sector row counts for itself and against the residual, and one
    aggregation settles both. A total without any sector row has no residual value (NULL).
    """
    keys = ["scenario", "region", "GHG", "Units", "year"]
    total = m.report_level("NCEM").select(*keys, F.lit(RESIDUAL).alias("sector"), F.lit("total").alias("part"), "value")
    parts = F.array(
        F.struct(F.col("sector"), F.lit("own").alias("part")), F.struct(F.lit(RESIDUAL).alias("sector"), F.lit("less").alias("part"))
    )
    sectors = (
        m.report_level("NCEM_sector")
        .select(*keys, "value", F.explode(parts).alias("p"))
        .select(*keys, F.col("p.sector").alias("sector"), F.col("p.part").alias("part"), "value")
    )
    land = m.report_level("CLUC").select(
        "scenario", "region", F.lit("CO2").alias("GHG"), "Units", "year", F.lit(LAND_USE).alias("sector"),
        F.lit("own").alias("part"), "value",
    )
    part = F.col("part")
    sums = union_all([total, sectors, land]).groupBy(*keys, "sector").agg(
        strict_sum_where(part == "own", "value").alias("own"),
        (strict_sum_where(part == "total", "value") - strict_sum_where(part == "less", "value")).alias("residual"),
        F.count_if(part == "own").alias("n_own"),
        F.count_if(part == "total").alias("n_total"),
    )
    value = (
        F.when((F.col("n_own") > 0) & (F.col("n_total") > 0), F.col("own") + F.col("residual"))
        .when(F.col("n_total") > 0, F.col("residual"))
        .otherwise(F.col("own"))
    )
    settled = sums.where((F.col("n_own") > 0) | (F.col("n_total") > 0))
    return m.stage("emissions_by_sector", settled.select(*keys, "sector", value.alias("value")))


def _co2(m: ModelInputs, rows: DataFrame, variable: str) -> DataFrame:
    return report_rows(
        series_sum(rows, "region"), Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"),
        Item="TOT", Variable=variable, Unit="MtCO2e", Value=carbon_to_co2(F.col("value")),
    )


def co2_by_code(m: ModelInputs) -> DataFrame:
    return _co2(m, by_sector(m).where(F.col("GHG") == "CO2"), "ECO2")


def co2(m: ModelInputs) -> DataFrame:
    """ECO2."""
    return region_rollup(co2_by_code(m))


def land_use_co2_by_code(m: ModelInputs) -> DataFrame:
    return _co2(m, by_sector(m).where(F.col("sector") == LAND_USE), LAND_USE)


def weighted_gases(m: ModelInputs) -> DataFrame:
    """Emissions other than CO2 with the gas label (``gas``) and weighted by each vintage.

    Sulphur sources share one gas; a gas outside the table has a NULL label and weight.
    """
    gas = F.when(F.col("GHG").contains("SO2_"), F.lit("SO2_3")).otherwise(F.col("GHG"))
    rows = by_sector(m).where(F.col("GHG") != "CO2").withColumn("GHG", gas)
    known = m.dims.gases.select("GHG", "family", "ar4", "ar5", F.coalesce("ar6", F.lit(0.0)).alias("ar6"))
    joined = rows.join(known, "GHG", "left")
    label = F.when(F.col("family") == fixed.OTHER_GASES, F.col("family")).when(F.col("family").isNotNull(), F.col("GHG"))
    label = F.when(F.col("sector") == UNMANAGED, F.concat(label, F.lit("_UnMGMTLand"))).otherwise(label)
    return joined.select(
        "scenario", "region", "year", "sector", label.alias("gas"),
        *[(F.col("value") * F.col(v)).alias(v) for v in ("ar6", "ar5", "ar4")],
    )


def farm_gases_by_code(m: ModelInputs) -> DataFrame:
    """ECH4 and EN2O by item in MtCO2e, items without emissions as zeros, with CRP, LSP and EMIS totals."""
    rows = weighted_gases(m).where(matches(F.col("gas"), "AGR|AWB") & ~matches(F.col("sector"), "Resource"))
    variable = F.coalesce(F.create_map(*[F.lit(x) for kv in FARM_GASES.items() for x in kv])[F.col("gas")], F.col("gas"))
    named = strict_lookup(
        rows, m.dims.items_of_commodities(), {"sector": "commodity"}, {"Item": "item"}, unique=True, what="commodities"
    )
    summed = named.groupBy("scenario", "region", "Item", variable.alias("Variable"), "year").agg(strict_sum("ar6").alias("Value"))
    tidy = report_rows(
        summed, Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"), Unit="MtCO2e"
    )
    animals = members("Item", LIVESTOCK)
    totals = [
        (f"NOT {animals}", {"Item": "CRP"}),
        (animals, {"Item": "LSP"}),
        (None, {"Variable": "EMIS"}),
        (f"NOT {animals}", {"Item": "CRP", "Variable": "EMIS"}),
        (animals, {"Item": "LSP", "Variable": "EMIS"}),
    ]
    return append_totals(densify(tidy, "Item", "Value"), totals)


def farm_gases(m: ModelInputs) -> DataFrame:
    """ECH4, EN2O and their sum EMIS."""
    return region_rollup(farm_gases_by_code(m))


def all_gases_by_code(m: ModelInputs) -> DataFrame:
    """All gases in MtCO2e by report code: CO2 and AR6-weighted others. Not part of the report."""
    gas = F.when(F.col("GHG").contains("SO2_"), F.lit("SO2_3")).otherwise(F.col("GHG"))
    weighted = lookup_default(by_sector(m).withColumn("GHG", gas), m.dims.gases, "GHG", {"ar6": 0.0}, unique=True)
    value = F.when(F.col("GHG").isin(CARBON), carbon_to_co2(F.col("value"))).otherwise(F.col("value") * F.col("ar6"))
    both = weighted.withColumn("value", value).where(F.col("value").isNotNull())
    return report_rows(
        series_sum(both, "region"), Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"),
        Item="TOT", Variable="GHGT", Unit="MtCO2e", Value=F.col("value"),
    )
