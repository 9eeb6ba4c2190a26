import pytest
from conftest import rows
from pyspark.sql import functions as F

from cropledger.operators import access, rollup

REPORT = "Region string, Year int, Value double"


def test_grouped_sum_renames_computes_and_adds_constants(make):
    df = make("scenario string, sector string, year int, value double", [("s", "Corn", 2015, 1.0), ("s", "corn", 2015, 2.0)])
    got = rollup.series_sum(df, F.lower("sector").alias("sector"), F.lit("Import").alias("element"))
    assert rows(got) == [("s", "corn", "Import", 2015, 3.0)]


def test_sum_all_but(make):
    df = make("a string, b string, Value double", [("x", "p", 1.0), ("x", "q", 2.0), ("y", "p", None)])
    assert rows(rollup.sum_all_but(df, "b")) == [("x", 3.0), ("y", None)]


def test_rollup_of_sums(make):
    df = make(REPORT, [("USA", 2015, 1.0), ("CAN", 2015, 2.0), ("ANZ", 2015, 4.0), ("BRA", 2020, None)])
    assert rows(rollup.region_rollup(df)) == [
        ("ANZ", 2015, 4.0), ("BRA", 2020, None), ("CAN", 2015, 2.0), ("NAM", 2015, 3.0), ("OAM", 2020, None),
        ("USA", 2015, 1.0), ("WLD", 2015, 7.0), ("WLD", 2020, None),
    ]


def test_rollup_of_weighted_means_keeps_own_values(make):
    df = make("Region string, Value double, weight double", [("USA", 1.0, 1.0), ("CAN", 4.0, 2.0), ("ANZ", 9.0, 0.0)])
    assert rows(rollup.region_rollup(df, weight="weight")) == [("ANZ", 9.0), ("CAN", 4.0), ("NAM", 3.0), ("USA", 1.0), ("WLD", 3.0)]


def test_rollup_of_a_region_without_code_counts_in_the_world(make):
    got = rows(rollup.region_rollup(make(REPORT, [(None, 2015, 1.0), ("USA", 2015, 2.0)])))
    assert (None, 2015, 1.0) in got and ("WLD", 2015, 3.0) in got


def test_rollup_refuses_its_own_output(make):
    with pytest.raises(Exception, match="already rolled up: WLD"):
        rollup.region_rollup(make(REPORT, [("WLD", 2015, 1.0)])).count()


def test_rollup_of_repeated_rows(make):
    df = make(REPORT, [("OSA", 2015, 1.0), ("OSA", 2015, 2.0)])
    with pytest.raises(Exception, match="repeated rows"):
        rollup.region_rollup(df).collect()
    assert rows(rollup.region_rollup(df, repeated_rows=True)) == [
        ("OAM", 2015, 3.0), ("OSA", 2015, 1.0), ("OSA", 2015, 2.0), ("WLD", 2015, 3.0)
    ]


def test_append_totals(make):
    df = make("Item string, Variable string, Value double", [("RIC", "ARIR", 1.0), ("RIC", "ARRF", 2.0), ("WHT", "ARIR", 4.0)])
    got = rollup.append_totals(
        df, [(None, {"Variable": "AREA"}), (None, {"Item": "CRP"}), (None, {"Variable": "AREA", "Item": "CRP"})]
    )
    assert rows(got) == [
        ("CRP", "AREA", 7.0), ("CRP", "ARIR", 5.0), ("CRP", "ARRF", 2.0), ("RIC", "AREA", 3.0), ("RIC", "ARIR", 1.0),
        ("RIC", "ARRF", 2.0), ("WHT", "AREA", 4.0), ("WHT", "ARIR", 4.0),
    ]


def test_append_subset_total_with_quote_in_label(make):
    df = make("Item string, Value double", [("a", 1.0), ("b", 2.0), ("it's", 4.0)])
    got = rollup.append_total(df, "Item", "a's", where=rollup.members("Item", ["a", "it's"]))
    assert rows(got) == [("a", 1.0), ("a's", 5.0), ("b", 2.0), ("it's", 4.0)]


def test_pluck(make):
    df = make(
        "scenario string, region string, year int, value double, ss string",
        [("BAU", "USA", 2014, 1.0, "x"), ("BAU", "USA", 2015, 2.0, "x"), ("??", "USA", 2050, 3.0, "x")],
    )
    regions = make("region string, code string", [("USA", "US")])
    got = access.pluck(df, ["BAU"], regions=regions)
    assert rows(got, "scenario", "region0", "region", "year", "value") == [(None, "USA", "US", 2050, 3.0), ("BAU", "USA", "US", 2015, 2.0)]
    assert access.pluck(df, ["BAU"], branch="b").columns == ["scenario", "region", "year", "value", "branch"]


def test_scenario_order(make):
    df = make("scenario string", [("b",), ("a",), ("z",), (None,)])
    assert rows(df.select("scenario", access.scenario_order(["b", "a"]))) == [(None, None), ("a", 2), ("b", 1), ("z", None)]
