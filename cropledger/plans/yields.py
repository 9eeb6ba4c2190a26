"""Crop production and yields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions.text import recode_values
from cropledger.functions.units import ej_to_mt
from cropledger.operators.lookup import lookup_matched
from cropledger.operators.rollup import append_totals, region_rollup, series_sum
from cropledger.operators.series import freeze_at
from cropledger.plans.inputs import ModelInputs, report_rows
from cropledger.plans.land import area_by_code, split_leaf_code

# Production variable -> area variable -> yield variable.
AREA_OF = {"PROD": "AREA", "PRIR": "ARIR", "PRRF": "ARRF"}
YIELD_OF = {"AREA": "YILD", "ARIR": "YIIR", "ARRF": "YIRF"}


def in_mt(df: DataFrame) -> DataFrame:
    """Energy rows turned into mass; rows in any other unit than EJ or Mt drop out."""
    value = F.when(F.col("Units") == "EJ", ej_to_mt(F.col("value"))).otherwise(F.col("value"))
    return df.where(F.col("Units").isin("EJ", "Mt")).withColumns({"value": value, "Units": F.lit("Mt")})


def production_by_code(m: ModelInputs) -> DataFrame:
    """PROD, PRIR, PRRF by crop item with the all-crop total."""
    split = split_leaf_code(in_mt(m.report_level("Agprod")), "technology")
    by_leaf = series_sum(split, "region", "LandLeaf", "IRR")
    labelled = lookup_matched(by_leaf, m.dims.leaves, "LandLeaf", ["item"], unique=True)
    by_item = series_sum(labelled.withColumn("value", F.col("value") * 1000), "region", "item", "IRR")
    rows = report_rows(
        by_item, Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"), Item=F.col("item"),
        Variable=recode_values(F.col("IRR"), {"IRR": "PRIR", "RFD": "PRRF"}), Unit="1000 t", Value=F.col("value"),
    )
    return append_totals(
        rows, [(None, {"Variable": "PROD"}), (None, {"Item": "CRP"}), (None, {"Variable": "PROD", "Item": "CRP"})]
    )


def crop_yield(m: ModelInputs) -> DataFrame:
    """YILD, YIIR, YIRF: production over harvested area, area weighted; no area means a yield of 0."""
    keys = ["Scenario", "Region", "Item", "Variable", "Year"]
    production = production_by_code(m).withColumn("Variable", recode_values(F.col("Variable"), AREA_OF))
    areas = area_by_code(m).select(*keys, F.col("Value").alias("weight"))
    rows = report_rows(
        production.join(areas, keys, "left"), "weight",
        Value=F.coalesce(F.try_divide("Value", "weight"), F.lit(0.0)),
        Variable=recode_values(F.col("Variable"), YIELD_OF),
        Unit=F.when(F.col("Item") == "ECP", F.lit("dm t/ha")).otherwise(F.lit("fm t/ha")),
    )
    return region_rollup(rows, weight="weight").fillna(0.0, ["Value"])


def frozen_production(m: ModelInputs) -> DataFrame:
    """Production by technology held at its base year: 2025 for biomass, the first year else."""
    production = series_sum(in_mt(m.report_level("Agprod")), "region0", "sector", "technology")
    return freeze_at(
        production, ["scenario", "region0", "sector", "technology"], "year", "value",
        [(F.col("sector") == "biomass", 2025), (None, m.years[0])],
    )
