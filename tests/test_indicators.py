"""Indicators on tables small enough to work out by hand."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cropledger.operators.reshape import union_all
from cropledger.plans import balance, emissions, figures, food, labour, land, report, resources, socio, yields
from cropledger.plans.inputs import ModelInputs
from cropledger.sources.dims import default_dimensions

COLUMNS = ["Scenario", "Region", "Item", "Variable", "Year", "Unit", "Value"]
LEVELS = {1975: 0.25, 1990: 0.5, 2005: 0.75, 2015: 1.0}
B = "scenario string, region string, year int, value double"

TABLES = {
    "GDPNS": (B, [("BAU", "Mexico", 2015, 1000.0), ("BAU", "Argentina", 2015, 2000.0), ("BAU", "USA", 2015, 4000.0), ("BAU", "USA", 2010, 9.0)]),
    "POP": (B, [("BAU", "Mexico", 2015, 1000.0), ("BAU", "Argentina", 2015, 3000.0), ("BAU", "USA", 2015, 2000.0)]),
    "Detailedland": (B + ", LandLeaf string", [
        ("BAU", "USA", 2015, 1.0, "CornC4_B1_IRR_hi"), ("BAU", "USA", 2015, 2.0, "CornC4_B1_RFD_lo"),
        ("BAU", "USA", 2015, 4.0, "Rice_B1_IRR_hi"), ("BAU", "USA", 2015, 8.0, "Softwood_Forest_B1"),
        ("BAU", "Russia", 2015, 0.0, "Rice_B1_IRR_hi"),
    ]),
    "harvests": ("region string, technology string, harvests_per_year double", [("USA", "Rice_B1_IRR_hi", 2.0)]),
    "exogenous_yield": ("region string, irr string, crop string, year int, scenario string, value double", [
        ("USA", "IRR", "CornC4", 2020, "nocc", 2.0), ("USA", "IRR", "CornC4", 2020, "rcp7p0", 1.0),
        ("USA", "IRR", "Rice", 2020, "nocc", 2.0), ("USA", "IRR", "Rice", 2020, "rcp7p0", 3.0),
        ("USA", "RFD", "CornC4", 2021, "nocc", 1.0), ("USA", "RFD", "Wheat", 2020, "nocc", 1.0),
    ]),
    "Aggland": (B + ", LandLeaf string", [
        ("BAU", "USA", 2015, 10.0, "CornC4"), ("BAU", "USA", 2015, 1.0, "Pasture"), ("BAU", "USA", 2015, 2.0, "Tundra"),
        ("BAU", "USA", 2015, 5.0, "NutsSeedsTree"), ("BAU", "USA", 2015, 5.0, "NutsSeeds"),
    ]),
    "Agprod": (B + ", sector string, technology string, Units string", [
        ("BAU", "USA", 2015, 5.0, "Corn", "CornC4_B1_IRR_hi", "Mt"), ("BAU", "USA", 2015, 7.0, "Corn", "CornC4_B1_RFD_lo", "Mt"),
        ("BAU", "USA", 2015, 1.75, "biomass", "biomassGrass_B1_RFD_lo", "EJ"), ("BAU", "USA", 2015, 3.0, "NutsSeeds", "NutsSeedsTree_B1_RFD_lo", "Mt"),
        ("BAU", "USA", 2015, 9.0, "Forest", "Forest", "bm3"), ("BAU", "Russia", 2015, 6.0, "Rice", "Rice_B1_IRR_hi", "Mt"),
    ]),
    "MeatProd": (B + ", sector string, Units string", [("BAU", "USA", 2015, 2.0, "Beef", "Mt"), ("BAU", "USA", 2015, 99.0, "Beef", "head")]),
    "AgBal": (B + ", sector string, input string, Units string", [
        ("BAU", "USA", 2015, 1.0, "FoodDemand_Staples", "regional corn", "Mt"), ("BAU", "USA", 2015, 2.0, "FeedCrops", "regional corn", "Mt"),
        ("BAU", "USA", 2015, 3.0, "NonFoodDemand_Crops", "regional corn", "Mt"), ("BAU", "USA", 2015, 4.0, "ethanol", "regional corn", "Mt"),
        ("BAU", "USA", 2015, 5.0, "FoodDemand_NonStaples", "OtherMeat_Fish", "Mt"), ("BAU", "USA", 2015, 5.0, "FeedCrops", "Pasture", "Mt"),
        ("BAU", "USA", 2015, 50.0, "FoodDemand_Staples", "regional corn", "EJ"), ("BAU", "USA", 2015, 1.5, "FeedCrops", "FodderHerb", "Mt"),
    ]),
    "AgStorageClose": (B + ", sector string", [("BAU", "USA", 2015, 5.0, "regional corn")]),
    "AgStorageOpen": (B + ", sector string", [("BAU", "USA", 2015, 3.0, "regional corn")]),
    "AgStorageCloseLoss": (B + ", sector string", [("BAU", "USA", 2015, 4.5, "regional corn")]),
    "RegAgsource": (B + ", sector string, subsector string", [
        ("BAU", "USA", 2015, 1.5, "total corn", "imported corn"), ("BAU", "USA", 2015, 8.0, "total corn", "domestic corn"),
    ]),
    "TradedAgsource": (B + ", sector string, subsector string, Units string", [
        ("BAU", "USA", 2015, 2.5, "traded corn", "USA traded corn", "Mt"), ("BAU", "USA", 2015, 1.0, "traded nuts_seeds", "USA traded nuts_seeds", "Mt"),
        ("BAU", "USA", 2015, 9.0, "traded iron", "USA traded iron", "Mt"), ("BAU", "USA", 2015, 0.5, "traded root_tuber", "Mexico traded root_tuber", "Mt"),
    ]),
    "Agprices": (B + ", sector string, Units string", [
        ("BAU", "USA", 2015, 0.5, "Corn", "$"), ("BAU", "USA", 2015, 2.0, "NutsSeeds", "$"), ("BAU", "Russia", 2015, 1.0, "Rice", "$"),
    ]),
    "Meatprices": (B + ", sector string, Units string", [("BAU", "USA", 2015, 4.0, "Beef", "$")]),
    "Fooddemand": (B + ", technology string", [("BAU", "USA", 2015, 365.0, "Corn"), ("BAU", "USA", 2015, 730.0, "OtherMeat_Fish"), ("ELM", "USA", 2015, 7.0, "Corn")]),
    "FooddemandExo": (B + ", technology string", [("BAU", "USA", 2015, 9.0, "Corn")]),
    "waste_share": ("region string, commodity string, year int, waste_share double, half_waste double", [
        ("USA", "Corn", 2015, 0.5, 0.25), ("USA", "OtherMeat_Fish", 2015, 0.0, 0.0),
    ]),
    "fish_share": ("region_id int, fish double, other_meat double", [(1, 1.0, 3.0)]),
    "uncovered_calories": ("region_id int, uncovered double, total double", [(1, 1.0, 5.0)]),
    "LaborWage": ("scenario string, market string, year int, value double", [("BAU", "MexicoLabor_Ag", 2015, 1.0), ("BAU", "ArgentinaLabor_Ag", 2015, 4.0)]),
    "LaborInputSector": (B + ", sector string", [("BAU", "Mexico", 2015, 2.0, "Corn"), ("BAU", "Argentina", 2015, 0.5, "Corn"), ("BAU", "Argentina", 2015, 0.5, "Rice")]),
    "labour_force": ("region_id int, scenario string, year int, value double", [(20, "ssp2", 2015, 6.0), (31, "ssp2", 2015, 6.0), (31, "ssp1", 2015, 99.0)]),
    "CO2Price": ("scenario string, market string, year int, value double", [("ELM", "USACO2", 2025, 44.0), ("ELM", "EU-15CO2", 2025, 1.0)]),
    "NCEM": (B + ", GHG string, Units string", [
        ("BAU", "USA", 2015, 100.0, "CO2", "MTC"), ("BAU", "USA", 2015, 12.0, "CH4_AGR", "Tg"), ("BAU", "USA", 2015, 5.0, "SF6", "Gg"),
    ]),
    "NCEM_sector": (B + ", GHG string, sector string, Units string", [
        ("BAU", "USA", 2015, 60.0, "CO2", "electricity", "MTC"), ("BAU", "USA", 2015, 8.0, "CH4_AGR", "Rice", "Tg"),
        ("BAU", "USA", 2015, 2.0, "CH4_AGR", "Beef", "Tg"), ("BAU", "USA", 2015, 1.0, "N2O_AGR", "Corn", "Tg"),
        ("BAU", "USA", 2015, 3.0, "N2O", "UnmanagedLand", "Tg"),
    ]),
    "CLUC": (B + ", Units string", [("BAU", "USA", 2015, 5.0, "MTC")]),
    "Water_Wsector": (B + ", sector string", [("BAU", "USA", 2015, 1.0, "Corn"), ("BAU", "USA", 2015, 2.0, "Rice"), ("BAU", "USA", 2015, 50.0, "industry"), ("BAU", "USA", 2015, 9.0, "Beef")]),
    "FertizerUse": (B + ", sector string", [("BAU", "USA", 2015, 0.5, "FodderHerb")]),
    "MeanTemp": ("scenario string, year int, value double", [("BAU", 2050, 2.0), ("BAU", 2045, 1.9), ("odd", 2050, 3.0)]),
    "ForcingTotal": ("scenario string, year int, value double", [("odd", 2050, 4.0)]),
}


@pytest.fixture(scope="module")
def m(spark):
    frames = {}

    def table(name):
        if name not in frames:
            schema, data = TABLES[name]
            frames[name] = spark.createDataFrame(data, schema)
        return frames[name]

    return ModelInputs(table, default_dimensions(spark), ["BAU", "ELM", "ELM_NoCC"], LEVELS)


def values(df, *keys, region="USA"):
    """{key columns: value} of one region."""
    found = {}
    for r in df.where(df.Region == region).collect():
        key = tuple(r[k] for k in keys)
        assert key not in found
        found[key[0] if len(key) == 1 else key] = pytest.approx(r["Value"]) if r["Value"] is not None else None
    return found


def test_gdp(m):
    assert rows(socio.gdp(m), "Region", "Value") == [("NAM", 6.0), ("OAM", 4.5), ("OSA", 4.5), ("USA", 6.0), ("WLD", 10.5)]
    assert rows(socio.gdp(m, pre_aggregate=False), "Region", "Value") == [
        ("NAM", 6.0), ("OAM", 4.5), ("OSA", 1.5), ("OSA", 3.0), ("USA", 6.0), ("WLD", 10.5)
    ]


def test_population(m):
    assert rows(report.checked(socio.population(m)), "Region", "Value") == [("NAM", 2.0), ("OAM", 4.0), ("OSA", 4.0), ("USA", 2.0), ("WLD", 6.0)]


def test_area(m):
    assert values(land.area(m), "Item", "Variable") == {
        ("CGR", "ARIR"): 100.0, ("CGR", "ARRF"): 200.0, ("CGR", "AREA"): 300.0, ("RIC", "ARIR"): 800.0, ("RIC", "AREA"): 800.0,
        ("CRP", "ARIR"): 900.0, ("CRP", "ARRF"): 200.0, ("CRP", "AREA"): 1100.0,
    }


def test_climate_yield_effect(m):
    got = land.climate_yield_effect(m)
    assert rows(got.select("Scenario").distinct()) == [("BAU",), ("ELM",)]
    assert values(got.where("Scenario = 'ELM'"), "Item", "Year") == {("CGR", 2020): -50.0, ("RIC", 2020): 50.0}
    assert values(got.where("Scenario = 'ELM'"), "Item", region="WLD") == {"CGR": -50.0, "RIC": 50.0}


def test_land_cover(m):
    land_only = values(land.land_cover(m, with_energy_area=False), "Item")
    assert land_only == {"CRP": 2000.0, "GRS": 100.0, "NLD": 200.0, "TOT": 2300.0, "AGR": 2100.0}


def test_yield(m):
    got = yields.crop_yield(m)
    assert values(got, "Item", "Variable")[("CGR", "YIIR")] == 50.0   # 5000 / 100
    assert values(got, "Item", "Variable")[("CGR", "YILD")] == 40.0   # 12000 / 300
    assert values(got, "Item", "Variable")[("VFN", "YILD")] == 0.0    # no area
    assert values(got, "Item", "Variable", region="FSU")[("RIC", "YILD")] == 0.0   # area 0
    assert {r[0] for r in rows(got.where("Item = 'ECP'"), "Unit")} == {"dm t/ha"}
    made = values(yields.production_by_code(m), "Item", "Variable")
    assert made[("ECP", "PRRF")] == 100000.0   # 1.75 EJ at 17.5 GJ/t, in 1000 t
    assert made[("CRP", "PROD")] == made[("CRP", "PRIR")].expected + made[("CRP", "PRRF")].expected


def test_balance(m):
    got = {(r.sector, r.element): r.value for r in balance.full_balance(m).where("region = 'USA'").collect()}
    assert {e: got[("corn", e)] for e in ("Food", "Feed", "Other use", "Bioenergy", "Import", "Export", "Production")} == {
        "Food": 1.0, "Feed": 2.0, "Other use": 3.0, "Bioenergy": 4.0, "Import": 1.5, "Export": 2.5, "Production": 12.0
    }
    assert (got[("corn", "Stock loss")], got[("corn", "Opening stocks")], got[("corn", "Closing stocks")]) == (0.5, 3.0, 4.5)
    assert (got[("corn", "Area")], got[("corn", "Yield")]) == (1.0, 12.0)
    assert (got[("nutsseeds", "Area")], got[("nutsseeds", "Yield")]) == (1.0, 3.0)
    assert (got[("beef", "Price")], got[("beef", "Revenue")]) == (4.0, 8.0)
    assert ("corn", "ClosingStockBeforeLoss") not in got


def test_quantities_and_prices(m):
    got = values(balance.quantities(m), "Item", "Variable")
    assert {v: got[("CGR", v)] for v in balance.QUANTITIES} == {
        "EXPO": 2500.0, "IMPO": 1500.0, "PROD": 12000.0, "NETT": 1000.0, "FOOD": 1000.0, "FEED": 2000.0, "CONS": 9500.0, "OTHR": 8000.0
    }
    assert got[("FSH_OAP", "PROD")] == 5000.0      # production set to food
    assert got[("OCR", "NETT")] == -1500.0         # fodder: export less feed
    assert got[("OCR", "OTHR")] == -1500.0
    for item in {i for i, _ in got}:
        closed = got[(item, "PROD")].expected - got[(item, "EXPO")].expected + got[(item, "IMPO")].expected
        assert closed - got[(item, "FOOD")].expected - got[(item, "FEED")].expected == got[(item, "OTHR")]
    assert ("LSP", "PROD") not in got
    assert values(balance.quantities(m, with_livestock_total=True), "Item", "Variable")[("LSP", "PROD")] == 7000.0
    price = values(balance.producer_price(m), "Item", "Variable")
    assert price[("CGR", "XPRP")] == price[("CGR", "XPRX")] == 2000.0   # 6 / 12 * 4 * 1000
    assert ("FSH_OAP", "XPRP") not in price and ("OCR", "XPRP") not in price   # nothing produced, no price


def test_calories(m):
    got = values(food.calories(m).where("Scenario = 'BAU'"), "Item", "Variable")
    assert got == {
        ("CGR", "CALI"): 500000.0, ("CGR", "CALO"): 1000000.0, ("FSH", "CALI"): 250000.0, ("FSH", "CALO"): 250000.0,
        ("OAP", "CALI"): 750000.0, ("OAP", "CALO"): 750000.0, ("LSP", "CALI"): 750000.0, ("LSP", "CALO"): 750000.0,
        ("CRP", "CALI"): 500000.0, ("CRP", "CALO"): 1000000.0,
        ("AGR", "CALI"): 1500000.0 * 2.25, ("AGR", "CALO"): 2000000.0 * 2.25,
    }
    single = values(food.calories(m, nec_mode="single"), "Item", "Variable")
    assert single[("AGR", "CALI")] == 1500000.0 * 1.25
    with pytest.raises(ValueError):
        food.calories(m, nec_mode="other")


def test_labour(m):
    assert values(labour.wage(m), "Variable", region="OSA") == {"AWAG": (1 * 2 + 4 * 1) / 3 * 4000}
    assert values(labour.employment(m), "Variable", region="OSA") == {"AEMP_abs": 3.0}
    assert values(labour.employment_share(m), "Variable", region="OAM") == {"AEMP_prcn": 25.0}


def test_carbon_price(m):
    assert rows(emissions.carbon_price(m), "Scenario", "Region", "Year", "Value") == [
        ("BAU", "WLD", 2025, 0.0), ("ELM", "WLD", 2025, 24.0), ("ELM_NoCC", "WLD", 2025, 0.0)
    ]


def test_emissions(m):
    by_sector = {(r.GHG, r.sector): r.value for r in emissions.by_sector(m).collect()}
    assert by_sector == {
        ("CO2", "Resource production"): 40.0, ("CO2", "electricity"): 60.0, ("CO2", "LULUCF"): 5.0,
        ("CH4_AGR", "Resource production"): 2.0, ("CH4_AGR", "Rice"): 8.0, ("CH4_AGR", "Beef"): 2.0,
        ("SF6", "Resource production"): None, ("N2O_AGR", "Corn"): 1.0, ("N2O", "UnmanagedLand"): 3.0,
    }
    assert values(emissions.co2(m), "Variable") == {"ECO2": 385.0}
    labels = {r.gas for r in emissions.weighted_gases(m).collect()}
    assert labels == {"CH4_AGR", "N2O_AGR", "N2O_UnMGMTLand", "Other GHGs"}
    farm = values(emissions.farm_gases(m), "Item", "Variable")
    assert (farm[("RIC", "ECH4")], farm[("RUM", "ECH4")], farm[("CGR", "ECH4")], farm[("CGR", "EN2O")]) == (216.0, 54.0, 0.0, 273.0)
    assert (farm[("CRP", "EMIS")], farm[("LSP", "EMIS")], farm[("CRP", "EN2O")]) == (489.0, 54.0, 273.0)
    assert values(emissions.all_gases_by_code(m), "Variable") == {"GHGT": 385.0 + 12 * 27 + 4 * 273}


def test_water_and_fertiliser(m):
    assert values(resources.water(m), "Item") == {"CGR": 1.0, "RIC": 2.0, "CRP": 3.0}
    assert values(resources.fertiliser(m), "Item") == {"OCR": 500.0, "CRP": 500.0}


def test_climate_figures(m):
    assert rows(figures.temperature_2050(m), "scenario", "value") == [(None, 3.0), ("BAU", 2.0)]
    assert rows(figures.forcing_2050(m), "scenario", "value") == [("odd", 4.0)]


def test_contract(m, make):
    good = make("Scenario string, Region string, Item string, Variable string, Year int, Unit string, Value double", [("s", "r", "i", "v", 2015, "u", 1.0)])
    assert report.checked(good).count() == 1
    with pytest.raises(report.BrokenContract):
        report.checked(good.withColumnRenamed("Unit", "Units"))
    bad = make(", ".join(f"{n} {t}" for n, t in good.dtypes), [("s", "r", "i", "v", 2015, "u", float("nan")), ("s", None, "i", "v", 2015, "u", 1.0)])
    with pytest.raises(Exception, match="missing entry in report row"):
        report.checked(bad).count()
    assert report.missing_values(bad).first().asDict() == {"Scenario": 0, "Region": 1, "Item": 0, "Variable": 0, "Year": 0, "Unit": 0, "Value": 1}


def test_report_of_small_inputs(m, tmp_path):
    names = ["gdp", "population", "area", "land_cover", "water"]
    whole = report.assemble(report.collect_tables(m, names), "MODEL")
    assert whole.columns == report.EXPORT_COLUMNS
    assert report.repeated_keys(whole).count() == 0
    report.write_report(whole, str(tmp_path / "out.csv"), single_file=True)
    files = list((tmp_path / "out.csv").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == ",".join(report.EXPORT_COLUMNS)


def test_one_file_is_sorted_and_equal_for_equal_rows(m, spark, tmp_path):
    whole = report.assemble(report.collect_tables(m, ["gdp", "population", "area", "water"]), "MODEL")
    texts = []
    for n in (1, 13):
        out = tmp_path / f"out{n}.csv"
        report.write_report(whole.repartition(n, "Value"), str(out), single_file=True)
        (file,) = out.glob("*.csv")
        texts.append(file.read_text())
        assert not list(tmp_path.glob("*.parts"))
    assert texts[0] == texts[1]
    head, *lines = texts[0].splitlines()
    assert head == ",".join(report.EXPORT_COLUMNS) and len(lines) == whole.count()
    back = rows(spark.read.option("header", "true").csv(str(tmp_path / "out1.csv")).selectExpr(*report.EXPORT_COLUMNS[:-1], "CAST(Value AS double)"))
    assert back == rows(whole.withColumn("Year", F.col("Year").cast("string")))


def test_probes_in_one_scan(m, spark, tmp_path):
    tables = report.collect_tables(m, ["gdp", "area"])
    whole = union_all([df.withColumn("name", F.lit(n)) for n, df in tables.items()])
    whole.unionByName(whole.where("name = 'gdp'").limit(1)).unionByName(
        whole.limit(1).withColumns({"Value": F.lit(-1.0), "Item": F.lit(None).cast("string"), "Variable": F.lit("NEW")})
    ).write.parquet(str(tmp_path / "report"))
    found = report.probes(spark.read.parquet(str(tmp_path / "report")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("RelationV2") == 1
    by = {}
    for r in found.collect():
        by.setdefault(r.probe, []).append(r)
    assert len(by["key"]) == 1 and by["key"][0].n == 2
    assert {r["name"] for r in by["table"]} == {"gdp", "area"} and sum(r.n for r in by["table"]) == by["report"][0].n == whole.count() + 2
    (new,) = [r for r in by["coverage"] if r.Variable == "NEW"]
    assert (new.n, new.negative, new.missing, new.missing_Item, new.missing_Value) == (1, 1, 1, 1, 0)
    assert by["report"][0].missing == 1 and by["report"][0].negative >= 1
