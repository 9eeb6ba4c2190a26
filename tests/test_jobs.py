"""Raw exports to report file, end to end on the small tables of the indicator tests."""

import csv
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_indicators import LEVELS, TABLES

from cropledger import jobs
from cropledger.operators.reshape import union_all
from cropledger.plans import report
from cropledger.plans.inputs import AUXILIARY
from cropledger.sources.store import Store


def write_wide(path, schema, data):
    """A raw export: title, header, one column per year, a trailing blank column; rows of the usual year."""
    names = [f.name for f in T.StructType.fromDDL(schema)]
    dims = [n for n in names if n not in ("scenario", "year", "value")]
    records = [dict(zip(names, row)) for row in data]
    year = Counter(r["year"] for r in records).most_common(1)[0][0]
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        f.write("some title\n")
        out = csv.writer(f)
        out.writerow(["scenario", *dims, year, ""])
        for r in records:
            if r["year"] == year:
                out.writerow([f"{r['scenario']},date=2024-1-1", *[r[d] for d in dims], r["value"], ""])


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tree")
    by_scenario = defaultdict(list)
    for name, (schema, data) in TABLES.items():
        if name in AUXILIARY:
            spark.createDataFrame(data, schema).write.parquet(f"{folder}/aux/{name}")
            continue
        for row in data:
            by_scenario[(name, row[0])].append(row)
    for (name, scenario), data in by_scenario.items():
        write_wide(folder / "raw" / "proj" / "v1" / scenario / f"{name}.csv", TABLES[name][0], data)
    made = Store(spark, f"{folder}/store")
    loaded = jobs.load(spark, f"{folder}/raw", "proj", made, ["v1"])
    assert set(loaded) == set(TABLES) - set(AUXILIARY)
    for name in AUXILIARY:
        jobs.add_auxiliary(made, name, f"{folder}/aux/{name}")
    return made


def test_report_end_to_end(spark, store, tmp_path):
    whole = jobs.build_report(store, "v1", ["BAU", "ELM", "ELM_NoCC"], LEVELS, "MODEL")
    report.write_report(whole, str(tmp_path / "out"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "out"))
    assert back.columns == report.EXPORT_COLUMNS
    assert {r[0] for r in rows(back.select("Variable").distinct())} >= {
        "GDPT", "POPT", "AREA", "YECC", "LAND", "YILD", "PROD", "OTHR", "XPRP", "XPRX", "CALO", "CALI", "AWAG",
        "AEMP_abs", "AEMP_prcn", "CTAX", "ECO2", "ECH4", "EN2O", "EMIS", "WATR", "FRTN",
    }
    assert report.repeated_keys(back).count() == 0
    shown = back.where("Variable IN ('POPT', 'WATR') AND Region = 'WLD' AND Item IN ('TOT', 'CRP')")
    assert rows(shown, "Variable", "Value") == [("POPT", "6.0"), ("WATR", "3.0")]


def test_scenario_list(spark, tmp_path):
    (tmp_path / "sets.csv").write_text("Scenario,Item\nBAU,CRP\n,LSP\nELM,\nBAU,TOT\n")
    assert jobs.scenario_list(spark, str(tmp_path / "sets.csv")) == ["BAU", "ELM"]


def test_listing_and_choices(spark, store, tmp_path, capsys):
    for version, scen, name in (("v1", "BAU", "prod"), ("v1", "EL2", "prod"), ("v1", "EL2", "land"), ("v2", "BAU", "prod")):
        path = tmp_path / "proj" / version / scen / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("title\nscenario,region,2015,Units,\nBAU,USA,1,Mt,\n")
    jobs.main(["list", str(tmp_path), "proj", "--version", "v1", "--scen", "EL2"])
    shown = capsys.readouterr().out.split("\n")
    assert [x for x in shown if x] == ["version\tv1", "version\tv2", "scen\tBAU", "scen\tEL2", "query\tland", "query\tprod"]
    jobs.main(["load", str(tmp_path), "proj", str(tmp_path / "s"), "--version", "v1", "--scen", "EL2", "--query", "land"])
    made = Store(spark, str(tmp_path / "s"))
    assert made.load("land").count() == 1
    with pytest.raises(FileNotFoundError):
        made.load("prod")


def test_report_job_with_own_mapping_and_figures(spark, store, tmp_path):
    (tmp_path / "sets.csv").write_text("Scenario\nBAU\nELM\nELM_NoCC\n")
    spark.createDataFrame(sorted(LEVELS.items()), "year int, level double").write.parquet(str(tmp_path / "levels"))
    regions = jobs.default_dimensions(spark).regions
    regions.write.parquet(str(tmp_path / "regions"))
    given = [store.folder, "v1", str(tmp_path / "out"), "--scenarios", str(tmp_path / "sets.csv"), "--price-levels", str(tmp_path / "levels"), "--work", str(tmp_path / "work")]
    jobs.main(["report", *given, "--model", "M", "--mapping", f"regions={tmp_path / 'regions'}"])
    assert spark.read.option("header", "true").csv(str(tmp_path / "out")).count() > 0
    given[2] = str(tmp_path / "figures")
    jobs.main(["figures", *given, "--figure", "annual_co2", "--figure", "wage_index"])
    assert sorted(x.name for x in (tmp_path / "figures").iterdir()) == ["annual_co2", "wage_index"]
    assert list((tmp_path / "work").iterdir()) == []


def test_shared_rows_are_told_by_table_not_by_bits(make):
    schema = "Scenario string, Region string, Item string, Variable string, Year int, Unit string, Value double"
    area = make(schema, [("S", "R", "ECP", "AREA", 2015, "u", 0.1 + 0.2), ("S", "R", "WHT", "AREA", 2015, "u", 1.0), ("S", "R", "WHT", "AREA", 2015, "u", 1.0)])
    cover = make(schema, [("S", "R", "ECP", "AREA", 2015, "u", 0.3), ("S", "R", "TOT", "LAND", 2015, "u", 5.0)])
    whole = report.assemble(report.without_shared({"area": area, "land_cover": cover}), "M")
    assert whole.count() == 4  # the two real rows stay, the energy-crop row comes once
    assert rows(report.repeated_keys(whole), "Item", "n") == [("WHT", 2)]
    assert report.assemble(report.without_shared({"land_cover": cover}), "M").count() == 2


def test_shared_rows_leave_a_written_report_in_one_scan(spark, make, tmp_path):
    schema = "Scenario string, Region string, Item string, Variable string, Year int, Unit string, Value double"
    row = ("BAU", "USA", "ECP", "AREA", 2015, "1000 ha", 1.0)
    cover = [row, ("BAU", "USA", "TOT", "LAND", 2015, "1000 ha", 1.0)]
    tables = {"area": make(schema, [row, row]), "land_cover": make(schema, cover), "water": make(schema, [row])}
    labelled = [df.withColumn("name", F.lit(name)) for name, df in tables.items()]
    union_all(labelled).write.parquet(str(tmp_path / "report"))
    written = spark.read.parquet(str(tmp_path / "report"))
    whole = report.rows_without_shared(written)
    assert rows(whole.drop("name")) == rows(union_all(list(report.without_shared(tables).values())))
    assert whole._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
