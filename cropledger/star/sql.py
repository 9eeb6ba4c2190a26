"""The same tables and indicators in plain SQL, as a check on the Spark plans.

Named fragments become common table expressions; a query pulls in the ones it mentions.
"""

from __future__ import annotations

import re

from cropledger.operators.rollup import SUPER_REGIONS, WORLD
from cropledger.sources import fixed
from cropledger.star import labels as lb


def text(value) -> str:
    if value is None:
        return "NULL"
    return repr(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def listed(members) -> str:
    return "[" + ", ".join(text(m) for m in members) + "]"


def among(members) -> str:
    return "(" + ", ".join(text(m) for m in members) + ")"


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def pick(members, index: str) -> str:
    return f"({listed(members)})[({index}) + 1]"


def level(to_year: int, base_year: int) -> str:
    return f"({lb.PRICE_LEVELS[to_year]}::DOUBLE / {lb.PRICE_LEVELS[base_year]}::DOUBLE)"


def strict(value: str) -> str:
    return f"CASE WHEN count({value}) = count(*) THEN sum({value}) END"


def strict_where(condition: str, value: str) -> str:
    return (
        f"CASE WHEN count({value}) FILTER (WHERE {condition}) = count(*) FILTER (WHERE {condition}) "
        f"THEN sum({value}) FILTER (WHERE {condition}) END"
    )


def wmean(value: str, weight: str) -> str:
    return (
        f"CASE WHEN count({weight}) = count(*) AND count(*) FILTER (WHERE {weight} <> 0 AND {value} IS NULL) = 0 "
        f"THEN sum(CASE WHEN {weight} <> 0 THEN {value} * {weight} END) / nullif(sum({weight}), 0) END"
    )


REPORT = "Scenario, Region, Item, Variable, Year, Unit"

BRIDGE = [(WORLD, code) for code in fixed.REPORT_REGIONS] + [(s, c) for s, members in SUPER_REGIONS.items() for c in members]


def rolled(source: str, weight: str | None = None) -> str:
    total = strict("Value") if weight is None else wmean("Value", weight)
    return (
        f"SELECT {REPORT}, Value FROM {source} UNION ALL "
        f"SELECT Scenario, b.code AS Region, Item, Variable, Year, Unit, {total} AS Value "
        f"FROM {source} JOIN f_bridge b ON b.member = {source}.Region "
        f"GROUP BY Scenario, b.code, Item, Variable, Year, Unit"
    )


def with_totals(source: str, totals: list[tuple[str, dict[str, str]]], value: str = "Value") -> str:
    """Source rows plus, per total, the strict sum with some dimensions overwritten by a label."""
    dims = REPORT.split(", ")
    parts = [f"SELECT {REPORT}, {value} FROM {source}"]
    for where, labels in totals:
        shown = ", ".join(f"{text(labels[d])} AS {d}" if d in labels else d for d in dims)
        kept = ", ".join(d for d in dims if d not in labels)
        parts.append(f"SELECT {shown}, {strict(value)} AS {value} FROM {source} WHERE {where} GROUP BY {kept}")
    return " UNION ALL ".join(parts)


_scenario = f"{pick(lb.SCENARIOS, 'CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1')}"
_year = (
    f"CAST(CASE WHEN year(o_orderdate) = {lb.LAST_ORDER_YEAR} THEN 2050 "
    f"ELSE 2015 + 5 * (year(o_orderdate) - {lb.FIRST_ORDER_YEAR}) END AS INTEGER)"
)
_region = pick(fixed.NATIVE_REGIONS, "c_nationkey")
_leaf = pick(lb.LEAVES, "p")
_crop = pick([None if i is None else lb.CROPS[i] for i in lb.CROP_OF_LEAF], "p")
_irr = "CASE WHEN irrigated THEN 'IRR' ELSE 'RFD' END"
_code = f"{_leaf} || '_B' || (s % 5) || '_' || {_irr} || '_' || CASE WHEN flag = 'N' THEN 'hi' ELSE 'lo' END"


def lines_sum(dims: str, value: str = "qty", where: str = "TRUE", base: str = "scenario, region0, year") -> str:
    return f"SELECT {base}{', ' + dims if dims else ''}, sum({value}) AS value FROM f_lines WHERE {where} GROUP BY ALL"


def named(names, column: str, value: str = "qty", where: str = "TRUE") -> str:
    return lines_sum(f"{pick(names, f'p % {len(names)}')} AS {column}", value, where)


FRAGMENTS: dict[str, str] = {
    # -- dimensions
    "f_code": values(fixed.region_rows(), "region0, code"),
    "f_bridge": values(BRIDGE, "code, member"),
    "f_leaves": values(fixed.leaf_rows(), "LandLeaf, cover, item"),
    "f_items": values([(c, i) for _, c, _, i in fixed.COMMODITIES if i], "commodity, item"),
    "f_crops": values([(c, i) for _, c, k, i in fixed.COMMODITIES if k == "Crop"], "commodity, item"),
    "f_gases": values(fixed.gas_rows(), "GHG, family, ar4, ar5, ar6"),
    "f_scenarios": values([(s,) for s in lb.SCENARIOS], "Scenario"),
    "f_native": values(list(enumerate(fixed.NATIVE_REGIONS, start=1)), "region_id, region0"),
    # -- facts
    "f_orders": f"SELECT o_orderkey, o_totalprice, {_scenario} AS scenario, {_region} AS region0, "
    f"c_nationkey + 1 AS region_id, {_year} AS year FROM orders JOIN customer ON c_custkey = o_custkey",
    "f_lines": f"SELECT scenario, region0, region_id, year, l_partkey % {lb.N_LEAVES} AS p, l_suppkey % {lb.N_SOURCES} AS s, "
    "l_linestatus = 'F' AS irrigated, l_returnflag AS flag, l_quantity AS qty, CAST(l_linenumber AS DOUBLE) AS ln "
    "FROM lineitem JOIN f_orders ON o_orderkey = l_orderkey",
    # -- query tables
    "t_gdp": "SELECT scenario, region0, year, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS value FROM f_orders GROUP BY ALL",
    "t_pop": "SELECT scenario, region0, year, CAST(count(*) AS DOUBLE) * 1000 AS value FROM f_orders GROUP BY ALL",
    "t_detailed": lines_sum(f"{_code} AS code, p"),
    "t_aggland": lines_sum(f"{_leaf} AS LandLeaf"),
    "t_agprod": lines_sum(
        f"{_code} AS code, {_crop} AS sector, CASE WHEN {_crop} = 'biomass' THEN 'EJ' ELSE 'Mt' END AS Units, p",
        where=f"{_crop} IS NOT NULL",
    ),
    "t_agbal": lines_sum(
        f"{pick(lb.USES, 's % 6')} AS sector, {pick(lb.SECTORS, f'p % {lb.N_COMMODITIES}')} AS input, "
        "CASE WHEN s = 11 THEN 'EJ' ELSE 'Mt' END AS Units"
    ),
    "t_close": named(lb.SECTORS, "sector", where="flag = 'A'"),
    "t_open": named(lb.SECTORS, "sector", where="flag = 'N'"),
    "t_closeloss": named(lb.SECTORS, "sector", where="flag = 'R'"),
    "t_regsource": lines_sum(
        f"'total ' || {pick(lb.SHORT_NAMES, f'p % {lb.N_COMMODITIES}')} AS sector, CASE WHEN irrigated THEN 'imported ' "
        f"ELSE 'domestic ' END || {pick(lb.SHORT_NAMES, f'p % {lb.N_COMMODITIES}')} AS subsector"
    ),
    "t_traded": "SELECT scenario, year, 'traded ' || name AS sector, region0 || ' traded ' || name AS subsector, value FROM ("
    + lines_sum(
        f"CASE WHEN s = 10 THEN 'iron' ELSE {pick(lb.SHORT_NAMES, f'p % {lb.N_COMMODITIES}')} END AS name",
        where=f"p % {lb.N_COMMODITIES} < {lb.N_TRADED} AND flag <> 'A'",
    )
    + ")",
    "t_meat": lines_sum(f"{pick(lb.MEATS, f'p % {len(lb.MEATS)}')} AS sector, CASE WHEN s = 11 THEN 'head' ELSE 'Mt' END AS Units"),
    "t_agprices": lines_sum(f"{_crop} AS sector", "ln / 8", f"{_crop} IS NOT NULL"),
    "t_meatprices": named(lb.MEATS, "sector", "ln / 8"),
    "t_food": named(lb.FOODS, "technology"),
    "t_foodexo": named(lb.FOODS, "technology", "ln"),
    "t_wage": "SELECT scenario, region0 || 'Labor_Ag' AS market, year, value FROM (" + lines_sum("", "ln / 16") + ")",
    "t_labour": named(lb.COMMODITIES, "sector", "qty / 64"),
    "t_co2price": "SELECT scenario, region0 || 'CO2' AS market, year, value FROM ("
    + lines_sum("", "ln / 16", "scenario IN ('ELM', 'EL2')") + ")",
    "t_ncem": lines_sum(f"{pick(lb.GASES, 's')} AS GHG", "qty + ln"),
    "t_ncemsector": lines_sum(
        f"{pick(lb.GASES, 's')} AS GHG, CASE WHEN {pick(lb.GASES, 's')} IN {among(lb.FARM_GASES)} "
        f"THEN {pick(lb.FOODS, f'p % {len(lb.FOODS)}')} ELSE {pick(lb.OTHER_SECTORS, f'p % {len(lb.OTHER_SECTORS)}')} END AS sector"
    ),
    "t_cluc": lines_sum("", "ln"),
    "t_water": lines_sum(f"CASE WHEN s = 0 THEN 'industry' ELSE {pick(lb.COMMODITIES, f'p % {lb.N_COMMODITIES}')} END AS sector"),
    "t_fert": named(lb.COMMODITIES, "sector", "ln"),
    # -- auxiliary tables
    "t_harvests": f"SELECT DISTINCT region0, {_code} AS code, 1.0::DOUBLE + p % 2 AS per_year FROM f_lines WHERE year = 2015 AND p % 3 = 0",
    "t_exyield": f"SELECT region0, {_irr} AS irr, {_leaf} AS crop, year, sum(qty) AS nocc, sum(qty + ln) AS rcp FROM f_lines GROUP BY ALL",
    "t_waste": f"SELECT DISTINCT region0, {pick(lb.FOODS, f'p % {len(lb.FOODS)}')} AS technology, year, "
    f"(1 + (p % {len(lb.FOODS)}) % 4) / 16.0::DOUBLE AS share, (1 + (p % {len(lb.FOODS)}) % 4) / 16.0::DOUBLE / 2 AS half FROM f_lines",
    "t_fish": "SELECT region_id, sum(CASE WHEN irrigated THEN qty ELSE 0 END) AS fish, "
    "sum(CASE WHEN irrigated THEN 0 ELSE qty END) AS other_meat FROM f_lines GROUP BY ALL",
    "t_uncovered": "SELECT region_id, sum(ln) AS uncovered, sum(qty + ln) AS total FROM f_lines GROUP BY ALL",
    "t_force": "SELECT region_id, year, sum(qty) AS value FROM f_lines GROUP BY ALL",
    # -- income and population
    "i_gdp": f"SELECT scenario AS Scenario, code AS Region, 'TOT' AS Item, 'GDPT' AS Variable, year AS Year, "
    f"'bn USD 2005 MER' AS Unit, sum(value) * {level(2005, 1990)} / 1000 AS Value FROM t_gdp JOIN f_code USING (region0) GROUP BY ALL",
    "i_gdp_native": f"SELECT scenario AS Scenario, code AS Region, 'TOT' AS Item, 'GDPT' AS Variable, year AS Year, "
    f"'bn USD 2005 MER' AS Unit, value * {level(2005, 1990)} / 1000 AS Value FROM t_gdp JOIN f_code USING (region0)",
    "i_pop": "SELECT scenario AS Scenario, code AS Region, 'TOT' AS Item, 'POPT' AS Variable, year AS Year, "
    "'million' AS Unit, sum(value) / 1000 AS Value FROM t_pop JOIN f_code USING (region0) GROUP BY ALL",
    "r_gdp": rolled("i_gdp"),
    "r_gdp_native": rolled("i_gdp_native"),
    "r_pop": rolled("i_pop"),
    # -- land
    # A leaf with an underscore splits into the wrong parts and drops out; harvests default to 1.
    "h_harvested": "SELECT d.scenario, d.region0, d.year, regexp_split_to_array(code, '[^A-Za-z0-9]+') AS parts, "
    "d.value * coalesce(h.per_year, 1) AS value FROM t_detailed d LEFT JOIN t_harvests h USING (region0, code)",
    "h_area_leaf": "SELECT scenario, region0, year, parts[1] AS leaf, parts[3] AS irr, sum(value) / 10 * 1000 AS value "
    "FROM h_harvested GROUP BY ALL",
    "h_area_item": "SELECT scenario, code, year, item, irr, sum(value) AS value FROM (SELECT scenario, code, year, parts[1] AS leaf, "
    "parts[3] AS irr, sum(value) / 10 * 1000 AS value FROM h_harvested JOIN f_code USING (region0) GROUP BY ALL) "
    "JOIN f_leaves ON LandLeaf = leaf WHERE item IS NOT NULL GROUP BY ALL",
    "h_area": "SELECT scenario AS Scenario, code AS Region, item AS Item, CASE irr WHEN 'IRR' THEN 'ARIR' WHEN 'RFD' THEN 'ARRF' ELSE irr END "
    "AS Variable, year AS Year, '1000 ha' AS Unit, value AS Value FROM h_area_item",
    "i_area": with_totals(
        "h_area", [("TRUE", {"Variable": "AREA"}), ("TRUE", {"Item": "CRP"}), ("TRUE", {"Variable": "AREA", "Item": "CRP"})]
    ),
    "r_area": rolled("i_area"),
    "h_landweight": "SELECT scenario, region0, leaf, irr, year, value FROM h_area_leaf WHERE year = 2015",
    "i_yecc": f"SELECT Scenario, Region, Item, 'YECC' AS Variable, Year, '%' AS Unit, Value, weight FROM ("
    f"SELECT code AS Region, item AS Item, y.year AS Year, {wmean('((rcp / nullif(nocc, 0) - 1) * 100)', 'w.value')} AS Value, sum(w.value) AS weight "
    "FROM t_exyield y JOIN h_landweight w ON w.region0 = y.region0 AND w.irr = y.irr AND w.leaf = y.crop "
    "JOIN f_code c ON c.region0 = y.region0 JOIN f_leaves l ON l.LandLeaf = y.crop "
    f"WHERE w.scenario = 'BAU' AND y.crop NOT IN {among(fixed.AREA_ITEM['ECP'])} AND l.item IS NOT NULL AND y.year % 5 = 0 GROUP BY ALL"
    ") CROSS JOIN f_scenarios WHERE Scenario NOT LIKE '%NoCC%'",
    "r_yecc": rolled("i_yecc", "weight"),
    "h_land": "SELECT scenario AS Scenario, code AS Region, cover AS Item, 'LAND' AS Variable, year AS Year, '1000 ha' AS Unit, "
    "sum(value) / 10 * 1000 AS Value FROM t_aggland JOIN f_code USING (region0) JOIN f_leaves USING (LandLeaf) GROUP BY ALL",
    "i_land": with_totals("h_land", [("TRUE", {"Item": "TOT"}), ("Item IN ('GRS', 'CRP')", {"Item": "AGR"})]),
    "r_land_cover": rolled("i_land"),
    "r_land": f"SELECT {REPORT}, Value FROM r_land_cover UNION ALL SELECT {REPORT}, Value FROM r_area WHERE Variable = 'AREA' AND Item = 'ECP'",
    # -- yields
    "h_prod_leaf": "SELECT scenario, code2 AS code, year, parts[1] AS leaf, parts[3] AS irr, sum(value) AS value FROM (SELECT a.scenario, c.code AS code2, a.year, "
    "regexp_split_to_array(a.code, '[^A-Za-z0-9]+') AS parts, CASE WHEN Units = 'EJ' THEN value * 1e9 / 17.5::DOUBLE / 1e6 ELSE value END AS value "
    "FROM t_agprod a JOIN f_code c USING (region0)) GROUP BY ALL",
    "h_prod": "SELECT scenario AS Scenario, code AS Region, item AS Item, CASE irr WHEN 'IRR' THEN 'PRIR' WHEN 'RFD' THEN 'PRRF' ELSE irr END AS Variable, "
    "year AS Year, '1000 t' AS Unit, sum(value * 1000) AS Value FROM h_prod_leaf JOIN f_leaves ON LandLeaf = leaf WHERE item IS NOT NULL GROUP BY ALL",
    "i_prod": with_totals(
        "h_prod", [("TRUE", {"Variable": "PROD"}), ("TRUE", {"Item": "CRP"}), ("TRUE", {"Variable": "PROD", "Item": "CRP"})]
    ),
    "i_yield": "SELECT p.Scenario, p.Region, p.Item, CASE p.Variable WHEN 'PROD' THEN 'YILD' WHEN 'PRIR' THEN 'YIIR' ELSE 'YIRF' END AS Variable, p.Year, "
    "CASE WHEN p.Item = 'ECP' THEN 'dm t/ha' ELSE 'fm t/ha' END AS Unit, coalesce(p.Value / nullif(a.Value, 0), 0) AS Value, a.Value AS weight "
    "FROM i_prod p LEFT JOIN i_area a ON a.Scenario = p.Scenario AND a.Region = p.Region AND a.Item = p.Item AND a.Year = p.Year "
    "AND a.Variable = CASE p.Variable WHEN 'PROD' THEN 'AREA' WHEN 'PRIR' THEN 'ARIR' ELSE 'ARRF' END",
    "r_yield": f"SELECT {REPORT}, coalesce(Value, 0) AS Value FROM ({rolled('i_yield', 'weight')})",
    # -- balance
    "b_demand": "SELECT scenario, region0, year, CASE WHEN regexp_matches(sector, 'NonFoodDemand') THEN 'Other use' "
    "WHEN regexp_matches(sector, 'ethanol|biomassOil') THEN 'Bioenergy' WHEN regexp_matches(sector, 'FoodDemand') THEN 'Food' "
    "WHEN regexp_matches(sector, 'FeedCrops|Fodder') THEN 'Feed' ELSE sector END AS element, "
    "regexp_replace(input, 'regional |_', '', 'g') AS sector, sum(value) AS value FROM t_agbal WHERE Units = 'Mt' GROUP BY ALL",
    "b_stocks": "SELECT scenario, region0, year, regexp_replace(sector, 'regional |_', '', 'g') AS sector, "
    "max(value) FILTER (WHERE kind = 'before') AS before, max(value) FILTER (WHERE kind = 'open') AS opening, "
    "max(value) FILTER (WHERE kind = 'after') AS after FROM (SELECT *, 'before' AS kind FROM t_close UNION ALL "
    "SELECT *, 'open' FROM t_open UNION ALL SELECT *, 'after' FROM t_closeloss) GROUP BY ALL",
    "b_storage": "SELECT scenario, region0, year, 'Closing stocks' AS element, sector, after AS value FROM b_stocks UNION ALL "
    "SELECT scenario, region0, year, 'Opening stocks', sector, opening FROM b_stocks UNION ALL "
    "SELECT scenario, region0, year, 'Stock loss', sector, before - after FROM b_stocks",
    "b_imports": "SELECT scenario, region0, year, 'Import' AS element, regexp_replace(sector, 'total |_', '', 'g') AS sector, "
    "sum(value) AS value FROM t_regsource WHERE contains(subsector, 'imported') GROUP BY ALL",
    "b_exports": "SELECT scenario, regexp_replace(replace(replace(subsector, clean, ''), ' traded ', ''), 'nuts_seeds|root_tuber', '', 'g') AS region0, "
    "year, 'Export' AS element, clean AS sector, value FROM (SELECT *, regexp_replace(sector, 'traded |_', '', 'g') AS clean FROM t_traded "
    "WHERE NOT contains(sector, 'iron'))",
    "b_production": "SELECT scenario, region0, year, 'Production' AS element, lower(sector) AS sector, sum(value) AS value FROM t_agprod "
    "WHERE Units = 'Mt' GROUP BY ALL UNION ALL SELECT scenario, region0, year, 'Production', lower(sector), sum(value) FROM t_meat "
    "WHERE Units = 'Mt' GROUP BY ALL",
    "b_price": "SELECT scenario, region0, year, lower(sector) AS sector, value AS price FROM t_agprices UNION ALL "
    "SELECT scenario, region0, year, lower(sector), value FROM t_meatprices",
    "b_priced": "SELECT p.*, price, p.value * price AS revenue FROM b_production p JOIN b_price USING (scenario, region0, year, sector)",
    "b_land": "SELECT scenario, region0, year, lower(regexp_replace(LandLeaf, 'C4$|Tree$', '')) AS sector, sum(value) / 10 AS area FROM t_aggland GROUP BY ALL",
    "b_area": "SELECT p.scenario, p.region0, p.year, p.sector, area, p.value / nullif(area, 0) AS rate FROM b_production p "
    "JOIN b_land USING (scenario, region0, year, sector)",
    "b_supply_use": "SELECT scenario, region0, year, element, sector, value FROM b_demand UNION ALL SELECT scenario, region0, year, element, sector, value FROM b_storage "
    "UNION ALL SELECT scenario, region0, year, element, sector, value FROM b_imports UNION ALL SELECT scenario, region0, year, element, sector, value FROM b_exports "
    "UNION ALL SELECT scenario, region0, year, element, sector, value FROM b_production",
    "b_full": "SELECT * FROM b_supply_use UNION ALL SELECT scenario, region0, year, 'Area', sector, area FROM b_area UNION ALL "
    "SELECT scenario, region0, year, 'Yield', sector, rate FROM b_area UNION ALL SELECT scenario, region0, year, 'Price', sector, price FROM b_priced "
    "UNION ALL SELECT scenario, region0, year, 'Revenue', sector, revenue FROM b_priced",
    "b_wide": "SELECT scenario, code, year, lower(sector) AS sector, "
    + ", ".join(f"coalesce({strict_where(f'element = {text(e)}', 'value')}, 0) AS {e}" for e in ("Food", "Feed", "Production", "Revenue", "Import", "Export"))
    + " FROM b_full JOIN f_code USING (region0) WHERE element IN ('Food', 'Feed', 'Production', 'Revenue', 'Import', 'Export') "
    "AND lower(sector) <> 'pasture' GROUP BY scenario, code, year, lower(sector)",
    "b_net": "SELECT * REPLACE (CASE WHEN sector = 'othermeatfish' THEN Food ELSE Production END AS Production), "
    "CASE WHEN sector = 'fodderherb' THEN Export - Feed ELSE Export - Import END AS Net FROM b_wide",
    "b_items": "SELECT scenario, code, year, item, sum(Food) AS Food, sum(Feed) AS Feed, sum(Production) AS Production, sum(Revenue) AS Revenue, "
    "sum(Import) AS Import, sum(Export) AS Export, sum(Net) AS Net FROM b_net JOIN (SELECT DISTINCT replace(lower(commodity), '_', '') AS sector, item "
    "FROM f_items) USING (sector) GROUP BY ALL",
    "b_quantities": "SELECT *, Production - Export AS Cons, Production - Export + Import - Food - Feed AS Othr FROM b_items",
    "i_quant": " UNION ALL ".join(
        f"SELECT scenario AS Scenario, code AS Region, item AS Item, '{v}' AS Variable, year AS Year, '1000 t' AS Unit, {c} * 1000 AS Value FROM b_quantities"
        for v, c in {
            "EXPO": "Export", "IMPO": "Import", "PROD": "Production", "NETT": "Net", "FOOD": "Food", "FEED": "Feed", "CONS": "Cons", "OTHR": "Othr",
        }.items()
    ),
    "r_quant": rolled("i_quant"),
    "i_price": f"SELECT scenario AS Scenario, code AS Region, item AS Item, 'XPRP' AS Variable, year AS Year, '2015 USD/t' AS Unit, "
    f"Revenue / nullif(Production, 0) * {level(2015, 1975)} * 1000 AS Value, Production AS weight FROM b_items WHERE item <> 'FSH_OAP'",
    "r_price_one": f"SELECT * FROM ({rolled('i_price', 'weight')}) WHERE Value IS NOT NULL",
    "r_price": "SELECT * FROM r_price_one UNION ALL SELECT * REPLACE ('XPRX' AS Variable) FROM r_price_one",
    # -- food
    "c_demand": f"SELECT * FROM t_foodexo WHERE scenario IN {among(fixed.DIET_SCENARIOS)} UNION ALL "
    f"SELECT * FROM t_food WHERE scenario NOT IN {among(fixed.DIET_SCENARIOS)}",
    "c_intake": "SELECT scenario AS Scenario, code AS Region, item AS Item, year AS Year, sum(value) AS intake, "
    f"sum(value / (1 - CASE WHEN scenario IN {among(fixed.HALF_WASTE_SCENARIOS)} THEN half ELSE share END)) AS avail "
    "FROM c_demand JOIN t_waste USING (region0, technology, year) JOIN f_items ON commodity = technology JOIN f_code USING (region0) GROUP BY ALL",
    "c_capita": "SELECT i.Scenario, i.Region, i.Item, i.Year, intake / 365 / p.Value * 1e6 AS intake, avail / 365 / p.Value * 1e6 AS avail, p.Value AS POP "
    "FROM c_intake i JOIN i_pop p ON p.Scenario = i.Scenario AND p.Region = i.Region AND p.Year = i.Year",
    "c_share": "SELECT code AS Region, sum(fish) / nullif(sum(fish + other_meat), 0) AS share FROM t_fish JOIN f_native USING (region_id) JOIN f_code USING (region0) GROUP BY ALL",
    "c_scale": "SELECT code AS Region, 1 + sum(uncovered) / nullif(sum(total - uncovered), 0) AS scale FROM t_uncovered JOIN f_native USING (region_id) JOIN f_code USING (region0) GROUP BY ALL",
    "c_split": "SELECT Scenario, Region, Item, Year, intake, avail, POP FROM c_capita WHERE Item <> 'FSH_OAP' UNION ALL "
    "SELECT Scenario, c.Region, 'FSH', Year, share * intake, share * avail, POP FROM c_capita c LEFT JOIN c_share s ON s.Region = c.Region WHERE Item = 'FSH_OAP' UNION ALL "
    "SELECT Scenario, c.Region, 'OAP', Year, (1 - share) * intake, (1 - share) * avail, POP FROM c_capita c LEFT JOIN c_share s ON s.Region = c.Region WHERE Item = 'FSH_OAP'",
    "c_all": "SELECT * FROM c_split UNION ALL "
    "SELECT Scenario, Region, 'LSP', Year, sum(intake), sum(avail), POP FROM c_split WHERE Item IN ('OAP', 'RUM', 'NRM', 'DRY') GROUP BY ALL UNION ALL "
    "SELECT Scenario, Region, 'CRP', Year, sum(intake), sum(avail), POP FROM c_split WHERE Item NOT IN ('OAP', 'RUM', 'NRM', 'DRY', 'FSH') GROUP BY ALL UNION ALL "
    "SELECT Scenario, t.Region, 'AGR', Year, intake * (1 + scale), avail * (1 + scale), POP FROM (SELECT Scenario, Region, Year, sum(intake) AS intake, sum(avail) AS avail, POP "
    "FROM c_split GROUP BY ALL) t JOIN c_scale s ON s.Region = t.Region",
    "i_cal": "SELECT Scenario, Region, Item, 'CALO' AS Variable, Year, 'kcal/cap/d' AS Unit, avail AS Value, POP AS weight FROM c_all UNION ALL "
    "SELECT Scenario, Region, Item, 'CALI', Year, 'kcal/cap/d', intake, POP FROM c_all",
    "r_cal": rolled("i_cal", "weight"),
    # -- labour
    "l_input": "SELECT scenario, region0, year, sum(value) AS weight FROM t_labour GROUP BY ALL",
    "i_wage": f"SELECT scenario AS Scenario, code AS Region, 'AGR' AS Item, 'AWAG' AS Variable, year AS Year, '2015 USD/person' AS Unit, "
    f"{wmean('value', 'weight')} * {level(2015, 1975)} * 1000 AS Value, sum(weight) AS weight FROM "
    "(SELECT *, replace(market, 'Labor_Ag', '') AS region0 FROM t_wage) LEFT JOIN l_input USING (scenario, region0, year) JOIN f_code USING (region0) GROUP BY scenario, code, year",
    "r_wage": rolled("i_wage", "weight"),
    "i_empl": "SELECT scenario AS Scenario, code AS Region, 'AGR' AS Item, 'AEMP_abs' AS Variable, year AS Year, 'Million' AS Unit, sum(value) AS Value "
    "FROM t_labour JOIN f_code USING (region0) GROUP BY ALL",
    "r_empl": rolled("i_empl"),
    "l_force": "SELECT code AS Region, year AS Year, sum(value) AS force FROM t_force JOIN f_native USING (region_id) JOIN f_code USING (region0) GROUP BY ALL",
    "i_emplshare": "SELECT e.Scenario, e.Region, e.Item, 'AEMP_prcn' AS Variable, e.Year, '% of labor force' AS Unit, e.Value / force * 100 AS Value, force AS weight "
    "FROM i_empl e JOIN l_force f ON f.Region = e.Region AND f.Year = e.Year",
    "r_emplshare": rolled("i_emplshare", "weight"),
    # -- carbon price and emissions
    "h_ctax": f"SELECT scenario AS Scenario, year AS Year, value * 12 / 44 * {level(2015, 1990)} AS Value FROM t_co2price WHERE market = 'USACO2'",
    "r_ctax": "SELECT s.Scenario, 'WLD' AS Region, 'TOT' AS Item, 'CTAX' AS Variable, y.Year, '2015 USD/tCO2e' AS Unit, coalesce(h.Value, 0) AS Value "
    "FROM (SELECT DISTINCT Year FROM h_ctax) y CROSS JOIN f_scenarios s LEFT JOIN h_ctax h ON h.Year = y.Year AND h.Scenario = s.Scenario",
    "e_sector": "SELECT scenario, code, year, GHG, sector, sum(value) AS value FROM t_ncemsector JOIN f_code USING (region0) GROUP BY ALL",
    "e_residual": "SELECT t.scenario, t.code, t.year, t.GHG, 'Resource production' AS sector, t.value - s.value AS value FROM "
    "(SELECT scenario, code, year, GHG, sum(value) AS value FROM t_ncem JOIN f_code USING (region0) GROUP BY ALL) t LEFT JOIN "
    "(SELECT scenario, code, year, GHG, sum(value) AS value FROM e_sector GROUP BY ALL) s USING (scenario, code, year, GHG)",
    "e_all": "SELECT * FROM e_sector UNION ALL SELECT * FROM e_residual UNION ALL "
    "SELECT scenario, code, year, 'CO2', 'LULUCF', sum(value) FROM t_cluc JOIN f_code USING (region0) GROUP BY ALL",
    "i_co2": f"SELECT scenario AS Scenario, code AS Region, 'TOT' AS Item, 'ECO2' AS Variable, year AS Year, 'MtCO2e' AS Unit, {strict('value')} * 44 / 12 AS Value "
    "FROM e_all WHERE GHG = 'CO2' GROUP BY ALL",
    "r_co2": rolled("i_co2"),
    "i_lulucf": f"SELECT scenario AS Scenario, code AS Region, 'TOT' AS Item, 'LULUCF' AS Variable, year AS Year, 'MtCO2e' AS Unit, {strict('value')} * 44 / 12 AS Value "
    "FROM e_all WHERE sector = 'LULUCF' GROUP BY ALL",
    "e_weighted": "SELECT scenario, code, year, sector, CASE WHEN sector = 'UnmanagedLand' THEN label || '_UnMGMTLand' ELSE label END AS gas, "
    "value * coalesce(ar6, CASE WHEN family IS NOT NULL THEN 0 END) AS ar6, value * ar5 AS ar5, value * ar4 AS ar4 FROM "
    "(SELECT a.*, g.family, g.ar4, g.ar5, g.ar6, CASE WHEN g.family = 'Other GHGs' THEN g.family WHEN g.family IS NOT NULL THEN g.GHG END AS label FROM "
    "(SELECT * REPLACE (CASE WHEN contains(GHG, 'SO2_') THEN 'SO2_3' ELSE GHG END AS GHG) FROM e_all WHERE GHG <> 'CO2') a LEFT JOIN f_gases g ON g.GHG = a.GHG)",
    "h_farm": f"SELECT scenario AS Scenario, code AS Region, item AS Item, CASE WHEN gas LIKE 'CH4%' THEN 'ECH4' ELSE 'EN2O' END AS Variable, year AS Year, "
    f"'MtCO2e' AS Unit, {strict('ar6')} AS Value FROM e_weighted JOIN f_items ON commodity = sector "
    "WHERE regexp_matches(gas, 'AGR|AWB') AND NOT contains(sector, 'Resource') GROUP BY ALL",
    "h_farm_dense": "SELECT k.Scenario, k.Region, i.Item, k.Variable, k.Year, k.Unit, coalesce(h.Value, 0) AS Value FROM "
    "(SELECT DISTINCT Scenario, Region, Variable, Year, Unit FROM h_farm) k CROSS JOIN (SELECT DISTINCT Item FROM h_farm) i LEFT JOIN h_farm h "
    "ON h.Scenario = k.Scenario AND h.Region = k.Region AND h.Variable = k.Variable AND h.Year = k.Year AND h.Item = i.Item",
    "i_farm": with_totals(
        "h_farm_dense",
        [
            ("Item NOT IN ('RUM', 'NRM', 'DRY')", {"Item": "CRP"}),
            ("Item IN ('RUM', 'NRM', 'DRY')", {"Item": "LSP"}),
            ("TRUE", {"Variable": "EMIS"}),
            ("Item NOT IN ('RUM', 'NRM', 'DRY')", {"Item": "CRP", "Variable": "EMIS"}),
            ("Item IN ('RUM', 'NRM', 'DRY')", {"Item": "LSP", "Variable": "EMIS"}),
        ],
    ),
    "r_farm": rolled("i_farm"),
    "i_allgas": "SELECT scenario AS Scenario, code AS Region, 'TOT' AS Item, 'GHGT' AS Variable, year AS Year, 'MtCO2e' AS Unit, sum(value) AS Value FROM "
    "(SELECT scenario, code, year, value * 44 / 12 AS value FROM e_all WHERE GHG = 'CO2' UNION ALL SELECT scenario, code, year, ar6 FROM e_weighted) "
    "WHERE value IS NOT NULL GROUP BY ALL",
    # -- water and fertiliser
    "h_water": "SELECT scenario AS Scenario, code AS Region, item AS Item, 'WATR' AS Variable, year AS Year, 'km3' AS Unit, sum(value) AS Value "
    "FROM t_water JOIN f_crops ON commodity = sector JOIN f_code USING (region0) GROUP BY ALL",
    "i_water": with_totals("h_water", [("TRUE", {"Item": "CRP"})]),
    "r_water": rolled("i_water"),
    "h_fert": "SELECT scenario AS Scenario, code AS Region, item AS Item, 'FRTN' AS Variable, year AS Year, '1000 t' AS Unit, sum(value) * 1000 AS Value "
    "FROM t_fert JOIN f_crops ON commodity = sector JOIN f_code USING (region0) GROUP BY ALL",
    "i_fert": with_totals("h_fert", [("TRUE", {"Item": "CRP"})]),
    "r_fert": rolled("i_fert"),
}

RESULT_OF = {
    "gdp": "r_gdp", "population": "r_pop", "area": "r_area", "climate_yield_effect": "r_yecc", "land_cover": "r_land",
    "crop_yield": "r_yield", "quantities": "r_quant", "producer_price": "r_price", "calories": "r_cal", "wage": "r_wage",
    "employment": "r_empl", "employment_share": "r_emplshare", "carbon_price": "r_ctax", "co2": "r_co2",
    "farm_gases": "r_farm", "water": "r_water", "fertiliser": "r_fert",
}


def with_fragments(select: str) -> str:
    """Put the fragments a statement mentions, and those they mention, in front of it."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z]_[a-z0-9_]+\b", body)):
            if name in FRAGMENTS and name not in order:
                visit(FRAGMENTS[name])
                if name not in order:
                    order.append(name)

    visit(select)
    if not order:
        return select
    ctes = ", ".join(f"{name} AS ({FRAGMENTS[name]})" for name in order)
    return f"WITH {ctes}, {select[5:]}" if select.startswith("WITH ") else f"WITH {ctes} {select}"


def report_select(fragment: str) -> str:
    return with_fragments(f"SELECT {REPORT}, round(Value, 6) AS Value FROM {fragment}")
