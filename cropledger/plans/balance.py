"""Commodity balance and the supply-use and price indicators built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.functions.aggregates import strict_sum, strict_sum_where
from cropledger.functions.text import USE_CLASSES, matches, recode_first_match, trade_partner, without
from cropledger.functions.units import thousand_km2_to_million_ha
from cropledger.operators.lookup import replicate_over, strict_natural_lookup
from cropledger.operators.reshape import pivot_longer, pivot_wider, union_all
from cropledger.operators.rollup import append_total, members, region_rollup, series_sum
from cropledger.plans.inputs import ModelInputs, report_rows

BRANCH = "report"
KEYS = ["branch", "scenario", "region", "sector", "year"]
ROW = [*KEYS, "element", "value"]
# Elements that reach the report, those that quantities and prices are made of.
REPORTED = ["Food", "Feed", "Production", "Revenue", "Import", "Export"]
AMOUNTS = ["Food", "Feed", "Production", "Import", "Export"]
PRICED = ["Production", "Revenue"]
# Label formats of the input.
REGIONAL, TOTAL, TRADED = "regional |_", "total |_", "traded |_"
IMPORTED, IRON, CROP_LEAF = "imported", "iron", "C4$|Tree$"
QUANTITIES = ["EXPO", "IMPO", "PROD", "NETT", "FOOD", "FEED", "CONS", "OTHR"]
FISH_AND_OTHER = "FSH_OAP"
LIVESTOCK = ["RUM", "NRM", "DRY"]


def demand(m: ModelInputs) -> DataFrame:
    """Demand in Mt by use class."""
    uses = m.native_level("AgBal", BRANCH).where(F.col("Units") == "Mt")
    return series_sum(
        uses, "branch", "region", recode_first_match(F.col("sector"), USE_CLASSES).alias("element"),
        without(F.col("input"), REGIONAL).alias("sector"),
    ).select(*ROW)


def storage(m: ModelInputs) -> DataFrame:
    """Opening and closing stocks and the loss between them."""
    tables = {"AgStorageClose": "ClosingStockBeforeLoss", "AgStorageOpen": "Opening stocks", "AgStorageCloseLoss": "Closing stocks"}
    stocks = union_all(
        [m.native_level(t, BRANCH).select(*KEYS, "value", F.lit(e).alias("element")) for t, e in tables.items()]
    ).withColumn("sector", without(F.col("sector"), REGIONAL))
    wide = pivot_wider(stocks, KEYS, "element", "value", list(tables.values()))
    lost = wide.withColumn("Stock loss", F.col("ClosingStockBeforeLoss") - F.col("Closing stocks"))
    measures = ["Closing stocks", "Opening stocks", "Stock loss"]
    return pivot_longer(lost.drop("ClosingStockBeforeLoss"), measures, "element", "value").select(*ROW)


def imports(m: ModelInputs) -> DataFrame:
    sources = m.native_level("RegAgsource", BRANCH).where(matches(F.col("subsector"), IMPORTED))
    return series_sum(
        sources, "branch", "region", without(F.col("sector"), TOTAL).alias("sector"), F.lit("Import").alias("element")
    ).select(*ROW)


def exports(m: ModelInputs) -> DataFrame:
    """Exports by the region named in the trade label."""
    traded = m.native_level("TradedAgsource", BRANCH).where((F.col("Units") == "Mt") & ~matches(F.col("sector"), IRON))
    traded = traded.withColumn("sector", without(F.col("sector"), TRADED))
    partner = trade_partner(F.col("subsector"), F.col("sector"))
    return traded.withColumns({"region": partner, "element": F.lit("Export")}).select(*ROW)


def production(m: ModelInputs) -> DataFrame:
    """Crop and meat production in Mt."""
    columns = [c for c in KEYS if c != "sector"]
    made = union_all(
        [
            m.native_level(t, BRANCH).where(F.col("Units") == "Mt").select(
                *columns, F.lower("sector").alias("sector"), F.lit(t).alias("source"), "value"
            )
            for t in ("Agprod", "MeatProd")
        ]
    )
    return series_sum(made, "branch", "region", "sector", F.lit("Production").alias("element"), "source").select(*ROW)


def supply_use(m: ModelInputs) -> DataFrame:
    """Balance rows: demand by class, stocks, imports, exports, production."""
    return union_all([demand(m), storage(m), imports(m), exports(m), production(m)])


def area_and_yield(m: ModelInputs) -> DataFrame:
    """Harvest area in Mha and yield of every commodity with land."""
    leaf = F.lower(without(F.col("LandLeaf"), CROP_LEAF)).alias("sector")
    land = series_sum(m.native_level("Aggland"), "region", leaf)
    land = land.select("scenario", "region", "sector", "year", thousand_km2_to_million_ha(F.col("value")).alias("Area"))
    made = production(m).withColumnRenamed("value", "Production")
    both = made.join(land, ["scenario", "region", "sector", "year"], "inner")
    rates = both.withColumn("Yield", F.try_divide("Production", "Area"))
    return pivot_longer(rates.drop("element", "Production"), ["Area", "Yield"], "element", "value").select(*ROW)


def priced_production(m: ModelInputs) -> DataFrame:
    """Production, price and revenue of everything produced; a product without a price fails."""
    prices = union_all([m.native_level(t, BRANCH).select(*KEYS, "value") for t in ("Agprices", "Meatprices")])
    prices = prices.withColumn("sector", F.lower("sector")).withColumnRenamed("value", "Price")
    made = production(m).withColumnRenamed("value", "Production").drop("element")
    return strict_natural_lookup(made, prices, what="prices").withColumn("Revenue", F.col("Production") * F.col("Price"))


def price_and_revenue(m: ModelInputs) -> DataFrame:
    return pivot_longer(priced_production(m).drop("Production"), ["Revenue", "Price"], "element", "value").select(*ROW)


def full_balance(m: ModelInputs) -> DataFrame:
    return m.stage("full_balance", union_all([supply_use(m), area_and_yield(m), price_and_revenue(m)]))


def _elements(m: ModelInputs, wanted: list[str]) -> DataFrame:
    """Balance rows of the wanted elements, from the tables those need and no others."""
    parts = []
    if {"Food", "Feed"} & set(wanted):
        parts.append(demand(m))
    if "Import" in wanted:
        parts.append(imports(m))
    if "Export" in wanted:
        parts.append(exports(m))
    if "Revenue" in wanted:
        parts.append(pivot_longer(priced_production(m).drop("Price"), ["Production", "Revenue"], "element", "value").select(*ROW))
    elif "Production" in wanted:
        parts.append(production(m))
    return union_all(parts).where(F.col("element").isin(wanted))


def items(m: ModelInputs, wanted: list[str] = REPORTED) -> DataFrame:
    """One row per scenario, report code, item and year with the reported elements and net trade as columns.

    Elements that are not wanted are not read and stay 0, and rows that only they have are absent. Where
    intermediates are shared, all elements are computed once.
    """
    if m.shares:
        wanted = REPORTED
    rows = m.code_of(_elements(m, wanted))
    cells = [
        F.coalesce(strict_sum_where(F.col("element") == e, "value"), F.lit(0.0)).alias(e) for e in REPORTED
    ]
    wide = (
        rows.withColumn("sector", F.lower("sector"))
        .where(F.col("sector") != "pasture")
        .groupBy("scenario", "Region", "sector", "year")
        .agg(*cells)
    )
    made = F.when(F.col("sector") == "othermeatfish", F.col("Food")).otherwise(F.col("Production"))
    net = F.when(F.col("sector") == "fodderherb", F.col("Export") - F.col("Feed")).otherwise(F.col("Export") - F.col("Import"))
    wide = wide.withColumns({"Production": made, "NETT": net})
    names = m.dims.items_of_commodities().select(
        F.regexp_replace(F.lower("commodity"), "_", "").alias("sector"), F.col("item").alias("Item")
    ).distinct()
    labelled = wide.join(names, "sector", "left")
    summed = labelled.groupBy("scenario", "Region", "Item", "year").agg(
        *[strict_sum(e).alias(e) for e in (*REPORTED, "NETT")]
    )
    return m.stage("balance_items", summed) if wanted == REPORTED else summed


def _thousand_t(amount: Column) -> Column:
    return amount * 1000


def quantities_by_code(m: ModelInputs) -> DataFrame:
    """EXPO IMPO PROD NETT FOOD FEED CONS OTHR in 1000 t."""
    wide = items(m, AMOUNTS).select(
        F.col("scenario").alias("Scenario"), "Region", F.col("year").alias("Year"), "Item",
        F.col("Export").alias("EXPO"), F.col("Import").alias("IMPO"), F.col("Production").alias("PROD"), "NETT",
        F.col("Food").alias("FOOD"), F.col("Feed").alias("FEED"),
        (F.col("PROD") - F.col("EXPO")).alias("CONS"),
        (F.col("CONS") + F.col("IMPO") - F.col("FOOD") - F.col("FEED")).alias("OTHR"),
    )
    return report_rows(pivot_longer(wide, QUANTITIES), Unit="1000 t", Value=_thousand_t(F.col("Value")))


def quantities(m: ModelInputs, *, with_livestock_total: bool = False) -> DataFrame:
    rows = quantities_by_code(m)
    if with_livestock_total:
        rows = append_total(rows, "Item", "LSP", where=members("Item", [FISH_AND_OTHER, *LIVESTOCK]))
    return region_rollup(rows)


def producer_price_by_code(m: ModelInputs, wanted: list[str] = REPORTED) -> DataFrame:
    """XPRP with production as ``weight``; nothing produced leaves the price NULL."""
    price = m.money(F.try_divide("Revenue", "Production"), 2015, 1975) * 1000
    return report_rows(
        items(m, wanted).where(F.col("Item") != FISH_AND_OTHER).withColumn("weight", F.col("Production")), "weight",
        Scenario=F.col("scenario"), Year=F.col("year"), Variable="XPRP", Unit="2015 USD/t", Value=price,
    )


def producer_price(m: ModelInputs) -> DataFrame:
    """XPRP and its copy XPRX, production weighted."""
    rolled = region_rollup(producer_price_by_code(m, PRICED), weight="weight").where(F.col("Value").isNotNull())
    return replicate_over(rolled.drop("Variable"), "Variable", ["XPRP", "XPRX"]).select(*rolled.columns)
