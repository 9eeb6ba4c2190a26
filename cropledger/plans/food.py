"""Food calories: intake and availability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import ratio_of_sums, strict_sum
from cropledger.functions.units import per_person_and_day
from cropledger.functions.text import among
from cropledger.operators.lookup import strict_lookup
from cropledger.operators.reshape import pivot_longer, union_all
from cropledger.operators.rollup import fan_out_totals, members, region_rollup, series_sum
from cropledger.plans.inputs import ModelInputs, report_rows
from cropledger.plans.socio import population_by_code
from cropledger.sources import fixed

ANIMAL = ["OAP", "RUM", "NRM", "DRY"]


def technologies(m: ModelInputs) -> DataFrame:
    """Technologies that the food demand of the report regions has: what the waste shares must know."""
    return m.report_level("Fooddemand").select("technology").distinct()


def food_demand(m: ModelInputs) -> DataFrame:
    """Calories by native region and commodity, from the scenario's own demand table."""
    own = m.in_years("FooddemandExo").where(F.col("scenario").isin(fixed.DIET_SCENARIOS))
    others = m.in_years("Fooddemand").where(~among(F.col("scenario"), fixed.DIET_SCENARIOS))
    columns = ["scenario", "region", "technology", "year", "value"]
    return series_sum(union_all([own.select(*columns), others.select(*columns)]), "region", "technology")


def intake_and_supply(m: ModelInputs) -> DataFrame:
    """Intake and availability (before waste) by report code and item."""
    waste = m.table("waste_share")
    keys = {"region": "region", "technology": "commodity", "year": "year"}
    eaten = strict_lookup(food_demand(m), waste, keys, ["waste_share", "half_waste"], what="waste shares")
    wasted = F.when(among(F.col("scenario"), fixed.HALF_WASTE_SCENARIOS), F.col("half_waste")).otherwise(F.col("waste_share"))
    eaten = eaten.withColumn("avail", F.try_divide(F.col("value"), 1 - wasted))
    named = strict_lookup(
        eaten, m.dims.items_of_commodities(), {"technology": "commodity"}, {"Item": "item"}, unique=True, what="commodities"
    )
    return (
        m.code_of(named)
        .groupBy(F.col("scenario").alias("Scenario"), "Region", "Item", F.col("year").alias("Year"))
        .agg(strict_sum("value").alias("intake"), strict_sum("avail").alias("avail"))
    )


def per_capita(m: ModelInputs) -> DataFrame:
    """kcal per person and day, with the population as ``POP``."""
    people = population_by_code(m).select("Scenario", "Region", "Year", F.col("Value").alias("POP"))
    joined = strict_lookup(
        intake_and_supply(m), people, ["Scenario", "Region", "Year"], ["POP"], unique=True, what="population"
    )
    return joined.withColumns({c: per_person_and_day(F.col(c), F.col("POP")) for c in ("intake", "avail")})


def fish_share(m: ModelInputs) -> DataFrame:
    shares = m.code_of_id(m.table("fish_share")).withColumn("both", F.col("fish") + F.col("other_meat"))
    return shares.groupBy("Region").agg(ratio_of_sums("fish", "both").alias("fish_share"))


def split_fish(m: ModelInputs) -> DataFrame:
    """The fish-and-other-meat item becomes FSH and OAP by the regional share."""
    cal = per_capita(m).join(fish_share(m), "Region", "left")
    share = F.col("fish_share")
    parts = F.when(
        F.col("Item") == "FSH_OAP",
        F.array(
            F.struct(F.lit("FSH").alias("Item"), share.alias("part")),
            F.struct(F.lit("OAP").alias("Item"), (1 - share).alias("part")),
        ),
    ).otherwise(F.array(F.struct(F.col("Item"), F.lit(1.0).alias("part"))))
    spread = cal.withColumn("p", F.explode(parts))
    return spread.select(
        "Scenario", "Region", F.col("p.Item").alias("Item"), "Year", "POP",
        (F.col("intake") * F.col("p.part")).alias("intake"), (F.col("avail") * F.col("p.part")).alias("avail"),
    )


def uncovered_scale(m: ModelInputs) -> DataFrame:
    """1 + calories not covered by items over those covered, by report code."""
    shares = m.code_of_id(m.table("uncovered_calories")).withColumn("covered", F.col("total") - F.col("uncovered"))
    return shares.groupBy("Region").agg((ratio_of_sums("uncovered", "covered") + 1).alias("scale"))


def calories(m: ModelInputs, *, nec_mode: str = "reference") -> DataFrame:
    """CALO and CALI with the CRP, LSP and AGR totals, population weighted.

    The AGR total is scaled up for uncovered food: by 1 + scale, where scale already holds the 1
    (``reference``), or by scale alone (``single``).
    """
    if nec_mode not in ("reference", "single"):
        raise ValueError(nec_mode)
    item = F.col("Item")
    totals = [
        (members("Item", ANIMAL), {"Item": "LSP"}),
        (f"NOT {members('Item', [*ANIMAL, 'FSH'])}", {"Item": "CRP"}),
        (None, {"Item": "AGR"}),
    ]
    measures = {"intake": strict_sum("intake"), "avail": strict_sum("avail"), "POP": F.max("POP")}
    rows = fan_out_totals(split_fish(m), totals, measures)
    rows = strict_lookup(rows, uncovered_scale(m), "Region", ["scale"], unique=True, what="uncovered calories")
    factor = F.when(item == "AGR", F.col("scale") + 1 if nec_mode == "reference" else F.col("scale")).otherwise(F.lit(1.0))
    rows = rows.withColumns({"CALO": F.col("avail") * factor, "CALI": F.col("intake") * factor}).drop("intake", "avail", "scale")
    long = pivot_longer(rows.withColumnRenamed("POP", "weight"), ["CALO", "CALI"])
    return region_rollup(report_rows(long, "weight", Unit="kcal/cap/d"), weight="weight")
