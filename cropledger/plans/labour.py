"""Farm wage and employment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import strict_sum, weighted_mean
from cropledger.functions.text import without
from cropledger.operators.lookup import lookup_matched
from cropledger.operators.rollup import region_rollup, series_sum
from cropledger.plans.inputs import ModelInputs, report_rows

# Wage market suffix and the population pathway of the labour force.
WAGE_MARKET = "Labor_Ag"
LABOUR_PATHWAY = "ssp2"


def wage(m: ModelInputs) -> DataFrame:
    """AWAG in 2015 USD per person, weighted by labour input."""
    wages = m.native_level("LaborWage").withColumn("region", without(F.col("market"), WAGE_MARKET))
    labour = series_sum(m.in_years("LaborInputSector"), "region").withColumnRenamed("value", "weight")
    joined = m.code_of(wages.join(labour, ["scenario", "region", "year"], "left"))
    means = joined.groupBy("scenario", "Region", "year").agg(
        weighted_mean("value", "weight").alias("mean"), strict_sum("weight").alias("weight")
    )
    rows = report_rows(
        means, "weight", Scenario=F.col("scenario"), Year=F.col("year"), Item="AGR", Variable="AWAG",
        Unit="2015 USD/person", Value=m.money(F.col("mean"), 2015, 1975) * 1000,
    )
    return region_rollup(rows, weight="weight")


def employment_by_code(m: ModelInputs) -> DataFrame:
    return report_rows(
        series_sum(m.report_level("LaborInputSector"), "region"), Scenario=F.col("scenario"), Region=F.col("region"),
        Year=F.col("year"), Item="AGR", Variable="AEMP_abs", Unit="Million", Value=F.col("value"),
    )


def employment(m: ModelInputs) -> DataFrame:
    """AEMP_abs."""
    return region_rollup(employment_by_code(m))


def employment_share(m: ModelInputs) -> DataFrame:
    """AEMP_prcn: employment over the labour force where that is known, weighted by the labour force."""
    force = m.code_of_id(m.table("labour_force").where(F.col("scenario") == LABOUR_PATHWAY))
    force = force.groupBy("Region", F.col("year").alias("Year")).agg(strict_sum("value").alias("weight"))
    known = lookup_matched(employment_by_code(m), force, ["Region", "Year"], ["weight"], unique=True)
    rows = report_rows(
        known, "weight", Variable="AEMP_prcn", Unit="% of labor force",
        Value=F.try_divide("Value", "weight") * 100,
    )
    return region_rollup(rows, weight="weight")
