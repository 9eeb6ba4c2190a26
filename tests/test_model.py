"""The star binding refuses labels and years it has no model counterpart for."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cropledger.plans import food, socio
from cropledger.star.model import SCHEMAS, StarModel, model_year, scenario_code


def test_known_years_and_scenarios(make):
    df = make("d date, p string", [(dt.date(1995, 1, 1), "1-URGENT"), (dt.date(2000, 5, 1), "4-NOT SPECIFIED"), (dt.date(2001, 5, 1), "5-LOW")])
    assert rows(df.select(model_year(F.col("d")), scenario_code(F.col("p")))) == [(2015, 0), (2040, 3), (2050, 4)]


@pytest.mark.parametrize("year", [1994, 2002])
def test_unknown_years_fail(make, year):
    with pytest.raises(Exception, match="no model year"):
        make("d date", [(dt.date(year, 1, 1),)]).select(model_year(F.col("d"))).collect()


@pytest.mark.parametrize("label", ["1-OTHER", "6-NEW", None, ""])
def test_unknown_scenarios_fail(make, label):
    with pytest.raises(Exception, match="no scenario"):
        make("p string", [(label,)]).select(scenario_code(F.col("p"))).collect()


def _star(make, folder):
    """Customers, orders (one order repeated, one of no known customer) and line items."""
    customers = [(1, "a", 0, 0.0, "m"), (2, "b", 7, 0.0, "m")]
    first, later = dt.datetime(1995, 3, 1), dt.datetime(2001, 1, 1)
    orders = [
        (1, 1, "O", 10.75, first, "1-URGENT"), (1, 1, "O", 10.75, first, "1-URGENT"), (2, 1, "O", 5.5, later, "2-HIGH"),
        (3, 2, "O", None, later, "2-HIGH"), (4, 9, "O", 99.0, first, "1-URGENT"),
    ]
    lines = [(n, 3 * n, n, 1, 2.0, 1.0, 0.0, 0.0, "N", "F", first) for n in (1, 2, 3)]
    for name, given in {"customer": customers, "orders": orders, "lineitem": lines}.items():
        make(SCHEMAS[name], given).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def test_a_staged_model_reads_the_orders_once(spark, make, tmp_path):
    _star(make, tmp_path)
    want = [(0, 1, 2015, 2.0, 20.0), (1, 1, 2050, 1.0, 5.0), (1, 8, 2050, 1.0, None)]
    columns = ["sc", "region_id", "year", "n", "price"]
    assert rows(StarModel(spark, str(tmp_path)).placed_orders(), *columns) == want
    staged = StarModel(spark, str(tmp_path), staged=True)
    assert rows(staged.placed_orders(), *columns) == want
    m = staged.inputs()
    for build in (socio.gdp, socio.population, food.per_capita):
        assert not [f for f in build(m).inputFiles() if str(tmp_path) in f]
    again = StarModel(spark, str(tmp_path), staged=True).placed_orders()
    assert again.inputFiles() == staged.placed_orders().inputFiles()


def test_orders_written_anew_are_summed_anew(spark, make, tmp_path):
    _star(make, tmp_path)
    assert StarModel(spark, str(tmp_path), staged=True).placed_orders().count() == 3
    order = [(1, 2, "O", 3.0, dt.datetime(1996, 1, 1), "5-LOW")]
    make(SCHEMAS["orders"], order).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert rows(StarModel(spark, str(tmp_path), staged=True).placed_orders()) == [(4, 8, 2020, 1.0, 3.0)]


COARSE = ["Aggland", "AgBal", "MeatProd", "Agprices", "Fooddemand", "FooddemandExo", "LaborWage", "LaborInputSector", "NCEM_sector",
          "CLUC", "Water_Wsector", "waste_share", "labour_force"]


def test_coarser_sums_give_the_same_tables(spark, make, tmp_path):
    _star(make, tmp_path)
    first = dt.datetime(1995, 3, 1)
    lines = [
        (o, part, supp, number, quantity, 1.0, 0.0, 0.0, flag, status, first)
        for o, part in ((1, 3), (2, 64), (3, None)) for supp in (11, 10, None)
        for number, quantity in ((1, 2.0), (None, 4.0), (3, None)) for flag, status in (("N", "F"), (None, "O"), ("A", None))
    ]
    make(SCHEMAS["lineitem"], lines + lines[:5]).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    plain, kept = (StarModel(spark, str(tmp_path), staged=True, keep_stages=keep) for keep in (False, True))
    fine = set(kept.lines().inputFiles())
    for name in [*COARSE, "NCEM", "exogenous_yield", "uncovered_calories"]:
        table = kept.table(name)
        assert rows(table) == rows(plain.table(name)), name
        assert name not in COARSE or not fine & set(table.inputFiles()), name
