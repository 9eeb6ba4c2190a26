import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cropledger.operators import series

SCHEMA = "k string, year int, value double"


def test_change_and_index(make):
    df = make(SCHEMA, [("a", 2020, 4.0), ("a", 2015, 2.0), (None, 2015, 0.0), (None, 2020, 5.0)])
    assert rows(series.change_from_first(df, ["k"], "year", "value")) == [(None, 2015, None), (None, 2020, None), ("a", 2015, 1.0), ("a", 2020, 2.0)]
    assert rows(series.change_from_first(df, ["k"], "year", "value", "abs")) == [(None, 2015, 0.0), (None, 2020, 5.0), ("a", 2015, 0.0), ("a", 2020, 2.0)]
    assert rows(series.index_to_year(df, ["k"], "year", "value", 2020)) == [(None, 2015, 0.0), (None, 2020, 1.0), ("a", 2015, 0.5), ("a", 2020, 1.0)]


def test_freeze_at(make):
    df = make(SCHEMA, [("bio", 2015, 1.0), ("bio", 2025, 2.0), ("corn", 2015, 3.0), ("corn", 2025, 4.0), ("late", 2025, 5.0)])
    got = series.freeze_at(df, ["k"], "year", "value", [(F.col("k") == "bio", 2025), (None, 2015)])
    assert rows(got) == [("bio", 2015, 2.0), ("bio", 2025, 2.0), ("corn", 2015, 3.0), ("corn", 2025, 3.0), ("late", 2025, None)]


def test_fill_annual(make):
    df = make(SCHEMA, [
        ("a", 2015, 0.0), ("a", 2018, 3.0), ("a", 2020, 5.0),
        ("flat", 2018, None), ("flat", 2020, 7.0),   # nothing before: flat at the start; 2015 is not added
        ("open", 2015, 1.0), ("open", 2018, 2.0),    # no last year: no years added
    ])
    got = rows(series.fill_annual(df))
    assert [(y, v) for k, y, v in got if k == "a"] == [(2015 + i, float(i)) for i in range(6)]
    assert [(y, v) for k, y, v in got if k == "flat"] == [(2016, 7.0), (2017, 7.0), (2018, 7.0), (2019, 7.0), (2020, 7.0)]
    assert [(y, v) for k, y, v in got if k == "open"] == [(2015, 1.0), (2018, 2.0)]


def test_fill_annual_rejects_a_repeated_year(make):
    with pytest.raises(Exception, match="repeated key"):
        series.fill_annual(make(SCHEMA, [("a", 2015, 0.0), ("a", 2015, 3.0)])).collect()


def test_cumulate(make):
    df = make(SCHEMA, [("a", 2015, 1.0), ("a", 2020, 2.0), ("a", 2025, 2.0)])
    assert rows(series.cumulate(df)) == [("a", 2020, 2.0), ("a", 2025, 12.0)]
    with pytest.raises(Exception, match="the data start after 2010"):
        series.cumulate(df, start=2010).collect()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abc"), st.dictionaries(st.integers(2015, 2027), st.integers(-9, 9), min_size=1), min_size=1))
def test_fill_annual_against_numpy(make, data):
    table = [(k, y, float(v)) for k, years in data.items() for y, v in years.items()]
    years = sorted({y for _, y, _ in table})
    missing = set(range(years[0], years[-1] + 1)) - set(years)
    expected = []
    for k, known in data.items():
        shown = set(known) | (missing if years[-1] in known else set())
        xs = sorted(known)
        expected += [(k, y, float(np.interp(y, xs, [known[x] for x in xs]))) for y in shown]
    got = rows(series.fill_annual(make(SCHEMA, table)))
    assert [t[:2] for t in got] == [t[:2] for t in sorted(expected)]
    assert np.allclose([t[2] for t in got], [t[2] for t in sorted(expected)])


def test_two_rows_in_a_base_year_fail(make):
    df = make(SCHEMA, [("a", 2015, 1.0), ("a", 2015, 2.0), ("a", 2020, 3.0)])
    with pytest.raises(Exception, match="more than one value for year=2015"):
        series.index_to_year(df, ["k"], "year", "value", 2015).collect()
    with pytest.raises(Exception, match="more than one value for year=2015"):
        series.freeze_at(df, ["k"], "year", "value", [(None, 2015)]).collect()
    assert series.index_to_year(df, ["k"], "year", "value", 2020).count() == 3
