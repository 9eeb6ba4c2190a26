"""Income and population."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.operators.rollup import region_rollup, series_sum
from cropledger.plans.inputs import ModelInputs, report_rows


def gdp(m: ModelInputs, *, pre_aggregate: bool = True) -> DataFrame:
    """GDPT. ``pre_aggregate=False`` keeps one row per native region, as some published tables do."""
    df = m.report_level("GDPNS")
    if pre_aggregate:
        df = series_sum(df, "region")
    rows = report_rows(
        df, Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"), Item="TOT", Variable="GDPT",
        Unit="bn USD 2005 MER", Value=m.money(F.col("value"), 2005, 1990) / 1000,
    )
    return region_rollup(rows, repeated_rows=not pre_aggregate)


def population_by_code(m: ModelInputs) -> DataFrame:
    df = series_sum(m.report_level("POP"), "region")
    return report_rows(
        df, Scenario=F.col("scenario"), Region=F.col("region"), Year=F.col("year"), Item="TOT", Variable="POPT",
        Unit="million", Value=F.col("value") / 1000,
    )


def population(m: ModelInputs) -> DataFrame:
    return region_rollup(population_by_code(m))
