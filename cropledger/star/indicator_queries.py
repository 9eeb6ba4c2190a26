"""Indicators, their stages, the figures and the whole report, over query tables derived from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.operators.reshape import union_all
from cropledger.plans import balance, emissions, figures, food, labour, land, report, socio, yields
from cropledger.session import WorkFolder, file_listing, fresh_folder
from cropledger.sources.dims import read_auxiliary
from cropledger.star.model import StarModel
from cropledger.star.registry import query
from cropledger.star.sql import REPORT, RESULT_OF, text, wmean


def _inputs(spark, sf, staged=True, keep_stages=False):
    """Model inputs over the written cube; a single scan of the line items needs no cube."""
    return StarModel(spark, sf, staged=staged, keep_stages=keep_stages).inputs()


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns or ("Value",)})


def _report(fragment):
    return f"SELECT {REPORT}, round(Value, 6) AS Value FROM {fragment}"


# Indicators that read the orders only, or the line items once.
SINGLE_SCAN = {"gdp", "gdp_by_native_region", "population", "employment", "carbon_price", "water", "fertiliser"}


def _add_table(name, build, fragment):
    @query(f"indicator_{name}", _report(fragment))
    def run(spark, sf):
        return rounded(report.checked(build(_inputs(spark, sf, staged=name not in SINGLE_SCAN))))


for _name, _build in report.TABLES.items():
    _add_table(_name, _build, RESULT_OF[_name])
_add_table("gdp_by_native_region", lambda m: socio.gdp(m, pre_aggregate=False), "r_gdp_native")
_add_table("all_gases", emissions.all_gases_by_code, "i_allgas")
_add_table("land_use_co2", emissions.land_use_co2_by_code, "i_lulucf")


# -- stages of the indicators ----------------------------------------------------------------------


@query("harvested_2015", "SELECT scenario, region0 AS region, leaf AS \"LandLeaf\", irr AS \"IRR\", year, value FROM h_landweight")
def harvested_2015(spark, sf):
    return land.harvested_2015(_inputs(spark, sf))


@query("crop_production", _report("i_prod"))
def crop_production(spark, sf):
    return rounded(yields.production_by_code(_inputs(spark, sf)))


@query("frozen_production", "SELECT scenario, region0, sector, technology, year, round(CASE WHEN sector = 'biomass' THEN max(CASE WHEN year = 2025 THEN v END) OVER w "
       "ELSE max(CASE WHEN year = 2015 THEN v END) OVER w END, 6) AS value FROM (SELECT scenario, region0, sector, code AS technology, year, "
       "CASE WHEN Units = 'EJ' THEN value * 1e9 / 17.5::DOUBLE / 1e6 ELSE value END AS v FROM t_agprod) WINDOW w AS (PARTITION BY scenario, region0, sector, technology)")
def frozen_production(spark, sf):
    return rounded(yields.frozen_production(_inputs(spark, sf)), "value")


_BALANCE = "SELECT 'report' AS branch, scenario, region0 AS region, sector, year, element, {value} AS value FROM {source}"


@query("balance_supply_use", _BALANCE.format(value="value", source="b_supply_use"))
def balance_supply_use(spark, sf):
    return balance.supply_use(_inputs(spark, sf))


@query("balance_storage", _BALANCE.format(value="value", source="b_storage"))
def balance_storage(spark, sf):
    return balance.storage(_inputs(spark, sf))


@query("balance_trade", _BALANCE.format(value="value", source="(SELECT * FROM b_imports UNION ALL BY NAME SELECT * FROM b_exports)"))
def balance_trade(spark, sf):
    m = _inputs(spark, sf)
    return union_all([balance.imports(m), balance.exports(m)])


@query("balance_area_yield", _BALANCE.format(value="round(value, 6)", source="(SELECT scenario, region0, year, sector, 'Area' AS element, area AS value FROM b_area "
       "UNION ALL SELECT scenario, region0, year, sector, 'Yield', rate FROM b_area)"))
def balance_area_yield(spark, sf):
    return rounded(balance.area_and_yield(_inputs(spark, sf)), "value")


@query("balance_price_revenue", _BALANCE.format(value="value", source="(SELECT scenario, region0, year, sector, 'Price' AS element, price AS value FROM b_priced "
       "UNION ALL SELECT scenario, region0, year, sector, 'Revenue', revenue FROM b_priced)"))
def balance_price_revenue(spark, sf):
    return balance.price_and_revenue(_inputs(spark, sf))


@query("balance_items", "SELECT scenario, code AS \"Region\", item AS \"Item\", year, Food AS \"Food\", Feed AS \"Feed\", Production AS \"Production\", Revenue AS \"Revenue\", "
       "Import AS \"Import\", Export AS \"Export\", Net AS \"NETT\" FROM b_items")
def balance_items(spark, sf):
    return balance.items(_inputs(spark, sf))


@query("quantities_with_livestock_total", f"WITH l AS (SELECT * FROM i_quant UNION ALL SELECT Scenario, Region, 'LSP', Variable, Year, Unit, sum(Value) FROM i_quant "
       "WHERE Item IN ('FSH_OAP', 'RUM', 'NRM', 'DRY') GROUP BY ALL) "
       f"SELECT {REPORT}, round(Value, 6) AS Value FROM l UNION ALL SELECT Scenario, b.code AS Region, Item, Variable, Year, Unit, round(sum(Value), 6) FROM l "
       "JOIN f_bridge b ON b.member = l.Region GROUP BY Scenario, b.code, Item, Variable, Year, Unit")
def quantities_with_livestock_total(spark, sf):
    return rounded(balance.quantities(_inputs(spark, sf), with_livestock_total=True))


@query("food_demand_switch", "SELECT scenario, region0 AS region, technology, year, value FROM c_demand")
def food_demand_switch(spark, sf):
    return food.food_demand(_inputs(spark, sf))


@query("food_intake_and_supply", "SELECT Scenario, Region, Item, Year, round(intake, 6) AS intake, round(avail, 6) AS avail FROM c_intake")
def food_intake_and_supply(spark, sf):
    return rounded(food.intake_and_supply(_inputs(spark, sf)), "intake", "avail")


@query("food_fish_split", "SELECT Scenario, Region, Item, Year, POP, round(intake, 6) AS intake, round(avail, 6) AS avail FROM c_split")
def food_fish_split(spark, sf):
    return rounded(food.split_fish(_inputs(spark, sf)), "intake", "avail")


@query("fish_share", "SELECT Region, share AS fish_share FROM c_share")
def fish_share(spark, sf):
    return food.fish_share(_inputs(spark, sf))


@query("uncovered_scale", "SELECT Region, scale FROM c_scale")
def uncovered_scale(spark, sf):
    return food.uncovered_scale(_inputs(spark, sf))


@query("emissions_by_sector", "SELECT scenario, code AS region, GHG, 'MTC' AS Units, year, sector, value FROM e_all")
def emissions_by_sector(spark, sf):
    return emissions.by_sector(_inputs(spark, sf))


@query("gwp_weighted_sum", "SELECT scenario, code AS region, gas, year, round(sum(ar6), 4) AS ar6, round(sum(ar5), 4) AS ar5, round(sum(ar4), 4) AS ar4 FROM e_weighted GROUP BY ALL")
def gwp_weighted_sum(spark, sf):
    rows = emissions.weighted_gases(_inputs(spark, sf))
    return rows.groupBy("scenario", "region", "gas", "year").agg(*[F.round(F.sum(v), 4).alias(v) for v in ("ar6", "ar5", "ar4")])


@query("farm_gases_with_totals", _report("i_farm"))
def farm_gases_with_totals(spark, sf):
    return rounded(emissions.farm_gases_by_code(_inputs(spark, sf)))


# -- report ----------------------------------------------------------------------------------------

_ALL = " UNION ALL ".join(f"SELECT {REPORT}, Value FROM {RESULT_OF[name]}" for name in report.TABLES)


# Written reports of this process by (application, tables): every check of the whole report reads the same rows.
_WRITTEN: dict[tuple, DataFrame] = {}


def _written(spark, sf):
    """All report tables as ``name`` and the report columns, assembled once and written."""
    tables = ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")
    listed = tuple(file_listing(spark, f"{sf.rstrip('/')}/{t}.parquet") for t in tables)
    key = (spark.sparkContext.applicationId, sf, listed)
    if key not in _WRITTEN:
        tables = report.collect_tables(_inputs(spark, sf, keep_stages=True))
        labelled = [df.withColumn("name", F.lit(name)) for name, df in tables.items()]
        _WRITTEN[key] = WorkFolder(spark).keep("report", union_all(labelled))
    return _WRITTEN[key]


def _whole(spark, sf):
    """The written report in one scan, with the model's label."""
    return report.assemble({"all": _written(spark, sf).drop("name")}, "MODEL")


def _published(spark, sf):
    """``_whole`` without the rows that two tables share."""
    return report.assemble({"all": report.rows_without_shared(_written(spark, sf)).drop("name")}, "MODEL")


@query("report_assemble", f"SELECT DISTINCT 'MODEL' AS Model, {REPORT}, round(Value, 6) AS Value FROM ({_ALL})")
def report_assemble(spark, sf):
    return rounded(_published(spark, sf))


@query("report_duplicate_keys", f"SELECT {REPORT}, count(*) AS n FROM ({_ALL}) GROUP BY ALL HAVING count(*) > 1")
def report_duplicate_keys(spark, sf):
    return report.repeated_keys(_whole(spark, sf))


@query("report_coverage", f"SELECT Scenario, Variable, count(*) AS n, min(Year) AS first_year, max(Year) AS last_year FROM ({_ALL}) GROUP BY ALL")
def report_coverage(spark, sf):
    return report.coverage(_whole(spark, sf))


@query("report_missing_values", f"SELECT count(*) - count(Scenario) AS \"Scenario\", count(*) - count(Region) AS \"Region\", count(*) - count(Item) AS \"Item\", count(*) - count(Variable) AS \"Variable\", "
       "count(*) - count(Year) AS \"Year\", count(*) - count(Unit) AS \"Unit\", count(*) - count(Value) AS \"Value\" FROM i_price")
def report_missing_values(spark, sf):
    return report.missing_values(balance.producer_price_by_code(_inputs(spark, sf)).drop("weight"))


@query("report_table_rows", " UNION ALL ".join(f"SELECT {text(name)} AS name, count(*) AS n FROM {RESULT_OF[name]}" for name in report.TABLES))
def report_table_rows(spark, sf):
    return _written(spark, sf).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("report_negative_values", "SELECT Scenario, Region, Item, Variable, Year, Unit, Value FROM r_quant WHERE Variable = 'NETT' AND Value < 0")
def report_negative_values(spark, sf):
    return report.negative_values(balance.quantities(_inputs(spark, sf)), "NETT")


@query("report_negative_prices", f"SELECT 'MODEL' AS Model, {REPORT}, round(Value, 6) AS Value FROM ({_ALL}) WHERE Variable = 'XPRP' AND Value < 0")
def report_negative_prices(spark, sf):
    return rounded(report.negative_values(_whole(spark, sf), "XPRP"))


@query("report_missing_entries", "SELECT " + ", ".join(f'count(*) - count({c}) AS "{c}"' for c in [*REPORT.split(", "), "Value"]) + f" FROM ({_ALL})")
def report_missing_entries(spark, sf):
    """Missing entries of the whole report, before the contract stops them."""
    return report.missing_values(_written(spark, sf).drop("name"))


@query("report_variables", f"SELECT DISTINCT Variable FROM ({_ALL})")
def report_variables(spark, sf):
    return report.distinct_variables(_whole(spark, sf))


@query("report_technologies", "SELECT DISTINCT technology FROM t_food")
def report_technologies(spark, sf):
    """The technologies present in food demand."""
    return food.technologies(_inputs(spark, sf))


_NAMED = " UNION ALL ".join(f"SELECT {text(name)} AS name, {REPORT}, Value FROM {RESULT_OF[name]}" for name in report.TABLES)
_MISSING = [f"count(*) FILTER ({c} IS NULL)" for c in report.REPORT_COLUMNS]


@query("report_probes", "SELECT CASE WHEN GROUPING(Region) = 0 THEN 'key' WHEN GROUPING(Scenario) = 0 THEN 'coverage' WHEN GROUPING(name) = 0 THEN 'table' ELSE 'report' END AS probe, "
       f"name, {', '.join(report.KEY)}, count(*) AS n, min(y) AS first_year, max(y) AS last_year, count(*) FILTER (round(Value, 6) < 0) AS negative, {' + '.join(_MISSING)} AS missing, "
       + ", ".join(f'{m} AS "missing_{c}"' for c, m in zip(report.REPORT_COLUMNS, _MISSING))
       + f" FROM (SELECT *, Year AS y FROM ({_NAMED})) GROUP BY GROUPING SETS (({', '.join(report.KEY)}), (Scenario, Variable), (name), ()) HAVING GROUPING(Region) = 1 OR count(*) > 1")
def report_probes(spark, sf):
    """All checks of the whole report in one scan of it."""
    return report.probes(_written(spark, sf))


@query("report_export_sorted", f"SELECT DISTINCT 'MODEL' AS \"Model\", {REPORT}, round(Value, 6) AS \"Value\" FROM ({_ALL})")
def report_export_sorted(spark, sf):
    """All tables as one sorted file, written by many tasks and read back."""
    path = f"{fresh_folder(spark)}/report.csv"
    report.write_report(_published(spark, sf), path, single_file=True)
    schema = "Model string, Scenario string, Region string, Item string, Variable string, Year int, Unit string, Value double"
    return rounded(read_auxiliary(spark, path, schema))


@query("report_export_csv", f"SELECT DISTINCT 'MODEL' AS \"Model\", {REPORT}, round(Value, 6) AS \"Value\" FROM ({_ALL})")
def report_export_csv(spark, sf):
    """All tables exported and read back."""
    path = f"{fresh_folder(spark)}/report.csv"
    report.write_report(_published(spark, sf), path)
    schema = "Model string, Scenario string, Region string, Item string, Variable string, Year int, Unit string, Value double"
    return rounded(read_auxiliary(spark, path, schema))


@query("report_spot_check", f"SELECT {REPORT}, round(Value, 6) AS Value FROM r_emplshare WHERE Scenario = 'BAU' AND Year = 2015")
def report_spot_check(spark, sf):
    return rounded(report.spot(labour.employment_share(_inputs(spark, sf)), "BAU", 2015))


# -- figures ---------------------------------------------------------------------------------------


def _snapshot(fragment, where, years, scale=1):
    shown = ", ".join(c for c in REPORT.split(", ") if c != "Year")
    return (
        f"SELECT {shown}, CAST(Year AS VARCHAR) AS Year, round(Value / {scale}, 6) AS Value FROM {fragment} "
        f"WHERE Region = 'WLD' AND Year IN ({', '.join(map(str, years))}) AND {where}"
    )


def _add_figure(name, build, sql, *columns, digits=6):
    @query(f"figure_{name}", sql)
    def run(spark, sf):
        return rounded(build(_inputs(spark, sf)), *columns, digits=digits)


_add_figure("area_snapshot", figures.area_snapshot, _snapshot("r_area", "Variable = 'AREA'", figures.SNAPSHOT, 1000))
_add_figure("land_snapshot", figures.land_snapshot, _snapshot("r_land", "Item NOT IN ('TOT', 'NLD')", figures.SNAPSHOT, 1000))
_add_figure("yield_snapshot", figures.yield_snapshot, _snapshot("r_yield", "Variable = 'YILD'", figures.YIELD_SNAPSHOT))
_add_figure(
    "supply_use_grid", figures.supply_use_grid,
    _snapshot(
        "r_quant",
        "Variable IN ('FOOD', 'FEED', 'PROD', 'OTHR', 'EXPO') AND Item IN ('RUM', 'NRM', 'DRY', 'WHT', 'OSD', 'SGC', 'VFN', 'CGR')",
        [2020, 2050], 1000,
    ),
)

_YEARS = list(range(2015, 2051, 5))


@query("figure_price_index", "SELECT Scenario, Region, Item, Variable, Unit, " + ", ".join(f"round(max(CASE WHEN Year = {y} THEN i END), 6) AS \"{y}\"" for y in _YEARS)
       + " FROM (SELECT *, Value / nullif(max(CASE WHEN Year = 2020 THEN Value END) OVER (PARTITION BY Scenario, Region, Item, Variable, Unit), 0) AS i FROM r_price_one WHERE Region = 'WLD') "
       "GROUP BY Scenario, Region, Item, Variable, Unit")
def figure_price_index(spark, sf):
    return rounded(figures.price_index(_inputs(spark, sf)), *[str(y) for y in _YEARS])


_add_figure("average_price", figures.average_price, f"SELECT Scenario, Year, Variable, Unit, round({wmean('Value', 'weight')}, 6) AS Value FROM i_price WHERE Value IS NOT NULL GROUP BY Scenario, Year, Variable, Unit")
_add_figure("prices_by_item", figures.prices_by_item, f"SELECT {REPORT}, weight AS \"PROD\", round(Value, 6) AS Value FROM i_price")
_add_figure("calories_2050", figures.calories_2050, f"SELECT {REPORT}, round(Value, 6) AS Value FROM r_cal WHERE Year = 2050 AND Item NOT IN ('AGR', 'CRP', 'LSP') AND Region IN ('WLD', 'SSA', 'USA')")
_add_figure(
    "wage_index", figures.wage_index,
    f"SELECT {REPORT}, round(Value, 6) AS Value, round(Value / nullif(first_value(Value) OVER (PARTITION BY Scenario, Region ORDER BY Year), 0), 6) AS \"Index\" FROM r_wage",
    "Value", "Index",
)
_add_figure("employment_share", figures.employment_share_shown, f"SELECT {REPORT}, round(Value, 6) AS Value FROM r_emplshare WHERE Region IN ('WLD', 'SSA', 'USA')")
_add_figure("carbon_price_from_2025", figures.carbon_price_from_2025, f"SELECT {REPORT}, round(Value, 6) AS Value FROM r_ctax WHERE Year >= 2025")
_add_figure("annual_co2", figures.annual_co2, "SELECT Scenario, Item, Variable, Unit, Year AS year, round(sum(Value) / 1000, 6) AS value FROM i_co2 GROUP BY Scenario, Item, Variable, Unit, Year", "value")


def _cumulative(fragment, where="TRUE"):
    """Annual values from 2020 to 2050 by linear interpolation, summed, in thousands."""
    keys = "Scenario, Item, Variable, Unit"
    return (
        f"WITH s AS (SELECT {keys}, Year AS y, sum(Value) AS v FROM {fragment} WHERE {where} GROUP BY {keys}, Year), "
        f"ends AS (SELECT {keys} FROM s WHERE y = (SELECT max(y) FROM s)), "
        "years AS (SELECT CAST(unnest(range(2020, 2051)) AS INTEGER) AS y), "
        f"grid AS (SELECT e.*, years.y FROM ends e CROSS JOIN years WHERE years.y NOT IN (SELECT y FROM s) UNION ALL SELECT {keys}, y FROM s WHERE y >= 2020), "
        "near AS (SELECT g.*, (SELECT max(y) FROM s WHERE s.Scenario = g.Scenario AND s.Item = g.Item AND s.y <= g.y) AS ya, "
        "(SELECT min(y) FROM s WHERE s.Scenario = g.Scenario AND s.Item = g.Item AND s.y >= g.y) AS yb FROM grid g), "
        f"total AS (SELECT n.Scenario, n.Item, n.Variable, n.Unit, CAST(2050 AS INTEGER) AS year, sum(CASE WHEN ya = yb THEN a.v WHEN ya IS NULL THEN b.v "
        "ELSE a.v + (b.v - a.v) * ((n.y - ya) / (yb - ya)::DOUBLE) END) / 1000 AS value FROM near n "
        "LEFT JOIN s a ON a.Scenario = n.Scenario AND a.Item = n.Item AND a.y = ya LEFT JOIN s b ON b.Scenario = n.Scenario AND b.Item = n.Item AND b.y = yb "
        "WHERE (n.Scenario, n.Item) IN (SELECT Scenario, Item FROM ends) GROUP BY n.Scenario, n.Item, n.Variable, n.Unit) "
    )


_SHOWN = "SELECT Scenario, Item, Variable, Unit, year, round(value, 4) AS value"
_add_figure("cumulative_co2", figures.cumulative_co2, _cumulative("i_co2") + _SHOWN + ", CASE WHEN value < 1000 THEN 'Mitigation' WHEN value >= 1000 THEN 'No Policy' END AS ss FROM total", "value", digits=4)
_add_figure("cumulative_land_use_co2", figures.cumulative_land_use_co2, _cumulative("i_lulucf") + _SHOWN + " FROM total WHERE value < 1000", "value", digits=4)
_add_figure("cumulative_farm_gases", figures.cumulative_farm_gases, _cumulative("i_farm", "Item IN ('LSP', 'CRP') AND Variable = 'EMIS'") + _SHOWN + " FROM total", "value", digits=4)
_add_figure("cumulative_water", figures.cumulative_water, _cumulative("i_water", "Item = 'CRP'") + _SHOWN + " FROM total", "value", digits=4)
_add_figure("cumulative_fertiliser", figures.cumulative_fertiliser, _cumulative("i_fert", "Item = 'CRP'") + _SHOWN + " FROM total", "value", digits=4)


@query("figure_temperature_2050", "SELECT scenario, year, sum(value) / 1000 / 1024 AS value FROM t_pop WHERE year = 2050 GROUP BY ALL")
def figure_temperature_2050(spark, sf):
    return figures.temperature_2050(_inputs(spark, sf))


@query("figure_forcing_2050", "SELECT scenario, year, sum(value) / 1048576 AS value, 'star' AS ss FROM t_gdp WHERE year = 2050 GROUP BY scenario, year")
def figure_forcing_2050(spark, sf):
    return figures.forcing_2050(_inputs(spark, sf))
