"""Irrigation water and fertiliser of crops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.operators.lookup import restrict_lookup
from cropledger.operators.rollup import append_total, region_rollup, series_sum
from cropledger.plans.inputs import ModelInputs, report_rows


def _crop_use(m: ModelInputs, table: str, variable: str, unit: str, value: Column) -> DataFrame:
    crops = restrict_lookup(m.report_level(table), m.dims.crops(), {"sector": "commodity"}, ["item"])
    rows = report_rows(
        series_sum(crops, "region", "item"), Scenario=F.col("scenario"), Region=F.col("region"), Item=F.col("item"),
        Year=F.col("year"), Variable=variable, Unit=unit, Value=value,
    )
    return append_total(rows, "Item", "CRP")


def water_by_code(m: ModelInputs) -> DataFrame:
    return _crop_use(m, "Water_Wsector", "WATR", "km3", F.col("value"))


def water(m: ModelInputs) -> DataFrame:
    """WATR."""
    return region_rollup(water_by_code(m))


def fertiliser_by_code(m: ModelInputs) -> DataFrame:
    return _crop_use(m, "FertizerUse", "FRTN", "1000 t", F.col("value") * 1000)


def fertiliser(m: ModelInputs) -> DataFrame:
    """FRTN."""
    return region_rollup(fertiliser_by_code(m))
