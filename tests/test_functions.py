import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cropledger.functions import aggregates, classes, text, units
from cropledger.functions.aggregates import exact_sum, ratio_of_sums, strict_sum, weighted_mean


def test_strict_sum_is_null_with_one_missing_value(make):
    df = make("k string, v double", [("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)])
    assert rows(df.groupBy("k").agg(aggregates.strict_sum("v"))) == [("a", None), ("b", 5.0)]


def test_strict_sum_where_needs_a_row(make):
    df = make("k string, e string, v double", [("a", "x", 1.0), ("a", "y", None), ("b", "y", 2.0)])
    got = df.groupBy("k").agg(
        aggregates.strict_sum_where(F.col("e") == "x", "v"), aggregates.strict_sum_where(F.col("e") == "y", "v")
    )
    assert rows(got) == [("a", 1.0, None), ("b", None, 2.0)]


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(1.0, 1.0), (3.0, 3.0)], 2.5),
        ([(1.0, 1.0), (None, 0.0)], 1.0),  # a row of zero weight never counts
        ([(1.0, 1.0), (None, 2.0)], None),
        ([(1.0, 1.0), (2.0, None)], None),
        ([(1.0, 0.0), (2.0, 0.0)], None),
    ],
)
def test_weighted_mean(make, pairs, expected):
    assert make("v double, w double", pairs).agg(aggregates.weighted_mean("v", "w")).first()[0] == expected


def test_ratio_of_sums_over_zero_is_null(make):
    df = make("k string, a double, b double", [("x", 1.0, 0.0), ("y", 1.0, 4.0), ("y", 1.0, 4.0)])
    assert rows(df.groupBy("k").agg(aggregates.ratio_of_sums("a", "b"))) == [("x", None), ("y", 0.25)]


def test_only_value_rejects_a_second_one(make):
    df = make("e string, v double", [("x", 1.0), ("x", 2.0)])
    with pytest.raises(Exception, match="more than one value for cell"):
        df.agg(aggregates.only_value(F.col("e") == "x", "v", "cell")).collect()


def test_units(make):
    df = make("v double", [(17.5,)])
    got = df.select(
        units.ej_to_mt(F.col("v")), units.carbon_to_co2(F.lit(12.0)), units.per_carbon_to_per_co2(F.lit(44.0)),
        units.thousand_km2_to_thousand_ha(F.lit(2.0)), units.per_person_and_day(F.lit(365.0), F.lit(2.0)),
        units.per_person_and_day(F.lit(365.0), F.lit(0.0)),
    ).first()
    assert list(got) == [1000.0, 44.0, 12.0, 200.0, 500000.0, None]


def test_price_ratio(make):
    levels = units.price_levels(make("year int, level double", [(1975, 0.5), (2015, 2.0)]))
    assert units.price_ratio(levels, 2015, 1975) == 4.0
    with pytest.raises(KeyError):
        units.price_ratio(levels, 2015, 1990)
    with pytest.raises(ValueError):
        units.price_levels(make("year int, level double", [(1975, 0.5), (1975, 0.6)]))


def test_recode_first_match_in_order(make):
    df = make("t string", [("NonFoodDemand_x",), ("FoodDemand_x",), ("FeedCrops",), ("biomassOil",), ("Trade",), (None,)])
    got = rows(df.select(text.recode_first_match(F.col("t"), text.USE_CLASSES)))
    assert got == [(None,), ("Bioenergy",), ("Feed",), ("Food",), ("Other use",), ("Trade",)]


def test_code_parts_too_few_and_too_many(make):
    df = make("c string", [("Corn_B1_IRR_hi",), ("Softwood_Forest",), ("a-b.c_d_e",)])
    got = rows(df.select(*text.code_parts(F.col("c"), ["l", "b", "i", "m"])))
    assert got == [("Corn", "B1", "IRR", "hi"), ("Softwood", "Forest", None, None), ("a", "b", "c", "d")]


def test_trade_partner(make):
    df = make("sub string, sec string", [("Brazil traded corn", "corn"), ("EU-15 traded root_tuber", "roottuber"), ("USA traded nuts_seeds", "nutsseeds")])
    assert rows(df.select(text.trade_partner(F.col("sub"), F.col("sec")))) == [("Brazil",), ("EU-15",), ("USA",)]


def test_matches_and_among_are_false_on_null(make):
    df = make("t string", [(None,)])
    assert tuple(df.select(text.matches(F.col("t"), "a"), ~text.among(F.col("t"), ["a"])).first()) == (False, True)


def test_right_closed_classes(make):
    df = make("v double", [(0.0,), (0.05,), (0.3,), (0.52,), (1.0,), (None,)])
    edges = df.agg(classes.rounded_breaks(F.min("v"), F.max("v"), 4)).scalar()
    got = df.withColumn("b", edges).select("v", classes.right_closed_label(F.col("v"), F.col("b"), 4))
    # 0.25 and 0.75 round half to even; the lowest break itself has no class
    assert rows(got) == [(None, None), (0.0, None), (0.05, "(0,0.2]"), (0.3, "(0.2,0.5]"), (0.52, "(0.5,0.8]"), (1.0, "(0.8,1]")]


def test_right_closed_labels_of_negative_breaks(make):
    df = make("v double", [(-1.0,), (-0.5,), (0.0,)])
    edges = df.agg(classes.rounded_breaks(F.min("v"), F.max("v"), 2)).scalar()
    got = df.withColumn("b", edges).select("v", classes.right_closed_label(F.col("v"), F.col("b"), 2))
    assert rows(got) == [(-1.0, None), (-0.5, "(-1,-0.5]"), (0.0, "(-0.5,0]")]


def test_class_below(make):
    df = make("v double", [(1.0,), (1000.0,), (None,)])
    assert rows(df.select(classes.class_below(F.col("v"), 1000.0, "low", "high"))) == [(None,), ("high",), ("low",)]


def test_exact_sums_have_equal_bits_in_any_order_and_partitions(spark):
    rng = random.Random(4)
    values = [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-9, 15) for _ in range(4000)] + [1e15, -1e15, 0.1, 0.2, 2.0**70, -(2.0**70)]
    rows_ = [(k % 3, v, rng.random()) for k, v in enumerate(values)]
    exact = [exact_sum("v").alias("s"), weighted_mean("v", "w", exact=True).alias("m"), ratio_of_sums("v", "w", exact=True).alias("r")]
    found = set()
    for n in (1, 7, 200):
        rng.shuffle(rows_)
        df = spark.createDataFrame(rows_, "g int, v double, w double").repartition(n)
        found.add(tuple(sorted((r.g, r.s.hex(), r.m.hex(), r.r.hex()) for r in df.groupBy("g").agg(*exact).collect())))
    assert len(found) == 1
    for g, total, _, _ in found.pop():
        assert float.fromhex(total) == pytest.approx(math.fsum(v for k, v, _ in rows_ if k == g), rel=1e-14)


@pytest.mark.parametrize(
    "values",
    [[0.1] * 10, [1e16, 1.0, -1e16], [-0.5, 2.0**-60], [-(2.0**40) - 0.25, 2.0**40], [3.0, None, 4.0], [0.0, -0.0], [2.0**79, 1.5, -(2.0**79)]],
)
def test_exact_sum_is_the_sum(make, values):
    got = make("v double", [(v,) for v in values]).agg(exact_sum("v")).first()[0]
    assert got == pytest.approx(math.fsum(v for v in values if v is not None), rel=1e-15, abs=2.0**-70)


def test_exact_sum_of_what_has_no_grid(make):
    df = make("g int, v double", [(1, math.inf), (1, 1.0), (2, math.nan), (3, 1e300), (3, 1e300), (4, None)])
    got = {r.g: r.s for r in df.groupBy("g").agg(exact_sum("v").alias("s")).collect()}
    assert got[1] == math.inf and math.isnan(got[2]) and got[3] == 2e300 and got[4] is None
    assert make("v double", [(1.0,), (None,)]).agg(strict_sum("v", exact=True)).first()[0] is None
