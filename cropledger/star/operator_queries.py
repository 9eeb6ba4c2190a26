"""Every operator on its own, over the whole star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cropledger.functions.aggregates import ratio_of_sums, strict_sum, strict_sum_where, weighted_mean
from cropledger.functions.classes import class_below, class_index, right_closed_label, rounded_breaks
from cropledger.functions.text import (
    USE_CLASSES, among, matches, recode_first_match, recode_values, trade_partner, without, without_pattern_of,
)
from cropledger.functions.units import carbon_to_co2, deflate, ej_to_mt, per_person_and_day
from cropledger.operators import access, lookup, reshape, rollup, series
from cropledger.plans.figures import basin_map
from cropledger.session import fresh_folder, write_and_read_back
from cropledger.star import labels as lb
from cropledger.star.facts import GROUPS, line_facts, named, nations, summed
from cropledger.star.model import read
from cropledger.star.registry import query
from cropledger.star.sql import strict, strict_where, wmean

ALL_SCENARIOS = list(lb.SCENARIO_OF)
KNOWN = ALL_SCENARIOS[:4]


# -- table access ----------------------------------------------------------------------------------


def _plucked(spark, sf, **options):
    """Query-table shape: native region, year, value, source tag."""
    cells = named(line_facts(spark, sf).groupBy("scenario", "nationkey", "year").agg(F.sum("value").alias("value")), spark, sf)
    table = cells.select("scenario", F.col("region0").alias("region"), "year", "value", F.lit("src").alias("ss"))
    return access.pluck(table, KNOWN, (1996, 2000), **options)


_PLUCK = (
    "SELECT CASE WHEN scenario <> '5-LOW' THEN scenario END AS scenario, {cols}, year, sum(value) AS value FROM o_obs "
    "WHERE year BETWEEN 1996 AND 2000 GROUP BY ALL"
)


@query("year_window_pluck", _PLUCK.format(cols="region0, region"))
def year_window_pluck(spark, sf):
    regions = nations(spark, sf).select(F.col("region0").alias("region"), F.col("region").alias("code"))
    return _plucked(spark, sf, regions=regions)


@query("native_pluck", _PLUCK.format(cols="region0 AS region"))
def native_pluck(spark, sf):
    return _plucked(spark, sf)


@query("branch_pluck", _PLUCK.format(cols="region0 AS region, 'report' AS branch"))
def branch_pluck(spark, sf):
    return _plucked(spark, sf, branch="report")


@query("derived_projection", "SELECT scenario, year, value / 100 AS money, value / 100 - weight AS net, (value / 100 - weight) * 2 AS doubled, n FROM "
       "(SELECT scenario, year, sum(value) AS value, sum(weight) AS weight, count(*) AS n FROM o_obs GROUP BY ALL)")
def derived_projection(spark, sf):
    cells = line_facts(spark, sf).groupBy("scenario", "year").agg(
        F.sum("value").alias("value"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")
    )
    shown = reshape.column_exprs(cells, money=F.col("value") / 100)
    shown = reshape.column_exprs(shown, net=F.col("money") - F.col("weight"))
    return reshape.column_exprs(shown, doubled=F.col("net") * 2).select("scenario", "year", "money", "net", "doubled", "n")


@query("row_predicates", "SELECT scenario, year, count(*) AS n, sum(weight) AS weight FROM o_obs WHERE scenario IN ('1-URGENT', '2-HIGH', '3-MEDIUM') "
       "AND NOT coalesce(nullif(returnflag, 'N') IN ('A'), FALSE) AND weight >= 10 AND regexp_matches(linestatus, '^F') AND year IN (1995, 1997, 1999, 2001) GROUP BY ALL")
def row_predicates(spark, sf):
    flag = F.nullif(F.col("returnflag"), F.lit("N"))
    kept = line_facts(spark, sf).where(
        F.col("scenario").isin(ALL_SCENARIOS[:3]) & ~among(flag, ["A"]) & (F.col("weight") >= 10)
        & matches(F.col("linestatus"), "^F") & F.col("year").isin(list(range(1995, 2002, 2)))
    )
    return kept.groupBy("scenario", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"))


@query("distinct_projection", "SELECT DISTINCT scenario, region, returnflag, year FROM o_obs")
def distinct_projection(spark, sf):
    cells = line_facts(spark, sf).select("scenario", "nationkey", "returnflag", "year").distinct()
    return named(cells, spark, sf).select("scenario", "region", "returnflag", "year").distinct()


@query("optional_filter", "SELECT 'all' AS choice, count(*) AS n FROM lineitem UNION ALL SELECT 'some', count(*) FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def optional_filter(spark, sf):
    lines = read(spark, sf, "lineitem")
    counts = [
        access.optional_filter(lines, "l_returnflag", members).agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("choice"), "n")
        for label, members in (("all", None), ("some", ["A", "R"]))
    ]
    return reshape.union_all(counts)


@query("scenario_conform_order", "SELECT s AS scenario, CASE s WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '1-URGENT' THEN 3 END AS place, n FROM "
       "(SELECT CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '3-MEDIUM', '1-URGENT') THEN o_orderpriority END AS s, count(*) AS n FROM orders GROUP BY ALL)")
def scenario_conform_order(spark, sf):
    wanted = ["4-NOT SPECIFIED", "3-MEDIUM", "1-URGENT"]
    orders = access.conform_scenario(read(spark, sf, "orders").select(F.col("o_orderpriority").alias("scenario")), wanted)
    counted = orders.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("scenario", access.scenario_order(wanted).alias("place"), "n")


# -- lookups ---------------------------------------------------------------------------------------


@query("strict_region_lookup", "SELECT region0, region, count(*) AS n, sum(value) AS value FROM o_obs GROUP BY ALL")
def strict_region_lookup(spark, sf):
    cells = line_facts(spark, sf).groupBy("nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return named(cells, spark, sf).select("region0", "region", "n", "value")


@query("unmatched_lookup_keys", "SELECT DISTINCT l_partkey AS partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)")
def unmatched_lookup_keys(spark, sf):
    lines = read(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey"))
    return lookup.unmatched_keys(lines, read(spark, sf, "part").where(F.col("p_size") <= 45), {"partkey": "p_partkey"})


@query("optional_lookup_matched", "SELECT brand, sum(l_quantity) AS weight, count(*) AS n FROM lineitem JOIN o_parts ON partkey = l_partkey WHERE kind IN ('SMALL', 'PROMO') GROUP BY ALL")
def optional_lookup_matched(spark, sf):
    lines = read(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("partkey")).agg(
        F.sum("l_quantity").alias("weight"), F.count(F.lit(1)).alias("n")
    )
    blank = F.when(F.col("p_type").isin("SMALL", "PROMO"), F.col("p_brand"))
    parts = read(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), blank.alias("brand"))
    labelled = lookup.lookup_matched(lines, parts, "partkey", ["brand"], what="part")
    return labelled.groupBy("brand").agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))


@query("optional_lookup_default", "SELECT l_returnflag AS returnflag, sum(l_quantity * coalesce(p.factor, 1)) AS weight FROM lineitem LEFT JOIN "
       "(SELECT p_partkey, p_size::DOUBLE AS factor FROM part WHERE p_size <= 20) p ON p_partkey = l_partkey GROUP BY ALL")
def optional_lookup_default(spark, sf):
    lines = read(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("partkey"), F.col("l_returnflag").alias("returnflag")).agg(
        F.sum("l_quantity").alias("weight")
    )
    factors = read(spark, sf, "part").where(F.col("p_size") <= 20).select(
        F.col("p_partkey").alias("partkey"), F.col("p_size").cast("double").alias("factor")
    )
    filled = lookup.lookup_default(lines, factors, "partkey", {"factor": 1.0}, what="part")
    return filled.groupBy("returnflag").agg(F.sum(F.col("weight") * F.col("factor")).alias("weight"))


@query("restrict_inner_lookup", "SELECT kind, scenario, sum(weight) AS weight FROM o_obs JOIN o_parts USING (partkey) WHERE size > 30 GROUP BY ALL")
def restrict_inner_lookup(spark, sf):
    cells = line_facts(spark, sf).groupBy("partkey", "scenario").agg(F.sum("weight").alias("weight"))
    wanted = read(spark, sf, "part").where(F.col("p_size") > 30).select(F.col("p_partkey").alias("partkey"), F.col("p_type").alias("kind"))
    return lookup.restrict_lookup(cells, wanted, "partkey", ["kind"]).groupBy("kind", "scenario").agg(F.sum("weight").alias("weight"))


@query("multi_key_fact_join", "SELECT a.scenario, a.region, a.year, a.value, r.value AS returned FROM (SELECT scenario, region, year, sum(value) AS value FROM o_obs GROUP BY ALL) a "
       "LEFT JOIN (SELECT scenario, region, year, sum(value) AS value FROM o_obs WHERE returnflag = 'R' AND year <> 1999 GROUP BY ALL) r USING (scenario, region, year)")
def multi_key_fact_join(spark, sf):
    returned = F.when((F.col("returnflag") == "R") & (F.col("year") != 1999), F.col("value"))
    # Both sides come from one written table of sums, so that the line items are read and joined once.
    cells = write_and_read_back(summed(spark, sf, value=F.col("value"), back=returned), fresh_folder(spark))
    part = cells.where(F.col("back").isNotNull()).select("scenario", "region", "year", F.col("back").alias("returned"))
    return cells.drop("back").join(part, ["scenario", "region", "year"], "left")


@query("natural_lookup", "SELECT scenario, region, year, value, price, value * price AS revenue FROM (SELECT scenario, region, year, sum(weight) AS value FROM o_obs GROUP BY ALL) "
       "JOIN (SELECT scenario, region, year, max(linenumber) / 4.0::DOUBLE AS price FROM o_obs GROUP BY ALL) USING (scenario, region, year)")
def natural_lookup(spark, sf):
    cells = line_facts(spark, sf).groupBy("scenario", "nationkey", "year").agg(
        F.sum("weight").alias("value"), F.max("linenumber").alias("top")
    )
    cells = named(cells, spark, sf).groupBy("scenario", "region", "year").agg(F.sum("value").alias("value"), F.max("top").alias("top"))
    cells = write_and_read_back(cells, fresh_folder(spark))
    prices = cells.select("scenario", "region", "year", (F.col("top") / F.lit(4.0)).alias("price"))
    return lookup.strict_natural_lookup(cells.drop("top"), prices, what="prices").withColumn("revenue", F.col("value") * F.col("price"))


@query("renamed_key_lookup", "SELECT brand, returnflag, sum(weight) AS weight FROM o_obs JOIN o_parts USING (partkey) GROUP BY ALL")
def renamed_key_lookup(spark, sf):
    lines = read(spark, sf, "lineitem").groupBy("l_partkey", F.col("l_returnflag").alias("returnflag")).agg(F.sum("l_quantity").alias("weight"))
    labelled = lookup.strict_lookup(lines, read(spark, sf, "part"), {"l_partkey": "p_partkey"}, {"brand": "p_brand"}, what="part")
    return labelled.groupBy("brand", "returnflag").agg(F.sum("weight").alias("weight"))


@query("replicate_scenarios", "SELECT c.region, c.year, s.scenario, c.value FROM (SELECT region, year, sum(value) AS value FROM o_obs WHERE scenario = '1-URGENT' GROUP BY ALL) c "
       "CROSS JOIN (SELECT DISTINCT o_orderpriority AS scenario FROM orders) s")
def replicate_scenarios(spark, sf):
    base = summed(spark, sf, value=F.col("value")).where(F.col("scenario") == "1-URGENT").drop("scenario")
    return lookup.replicate_over_observed(base, "scenario", read(spark, sf, "orders"), "o_orderpriority", many=False)


@query("key_grid", "SELECT scenario, region0 FROM (SELECT DISTINCT o_orderpriority AS scenario FROM orders) CROSS JOIN (SELECT n_name AS region0 FROM nation)")
def key_grid(spark, sf):
    keys = nations(spark, sf).select("region0")
    return lookup.replicate_over_observed(keys, "scenario", read(spark, sf, "orders"), "o_orderpriority").select("scenario", "region0")


# -- aggregation -----------------------------------------------------------------------------------


@query("grouped_sum_expr", "SELECT scenario, lower(region0) AS place, 'Import' AS element, year, sum(value) AS value FROM o_obs GROUP BY ALL")
def grouped_sum_expr(spark, sf):
    cells = summed(spark, sf, by_region="region0", value=F.col("value"))
    return rollup.series_sum(cells, F.lower("region0").alias("place"), F.lit("Import").alias("element"))


# Doubles that no binary fraction meets; fsum is the compensated sum.
_UNEVEN = "u AS (SELECT scenario, region0, region, year, returnflag, value * (linenumber + 0.1::DOUBLE) / 7000 AS value, weight / 3 AS weight FROM o_obs)"


def _uneven(spark, sf):
    facts = named(line_facts(spark, sf), spark, sf)
    value = F.col("value") * (F.col("linenumber") + F.lit(0.1)) / F.lit(7000)
    return facts.withColumns({"value": value, "weight": F.col("weight") / F.lit(3)})


@query("exact_grouped_sum", f"WITH {_UNEVEN} SELECT scenario, region, year, round(fsum(value), 6) AS value FROM u GROUP BY ALL")
def exact_grouped_sum(spark, sf):
    return rollup.series_sum(_uneven(spark, sf), "region", exact=True).withColumn("value", F.round("value", 6))


@query("exact_weighted_mean", f"WITH {_UNEVEN} SELECT region0, returnflag, round(fsum(value * weight) / fsum(weight), 6) AS mean, round(fsum(value) / fsum(weight), 6) AS ratio FROM u GROUP BY ALL")
def exact_weighted_mean(spark, sf):
    means = [weighted_mean("value", "weight", exact=True).alias("mean"), ratio_of_sums("value", "weight", exact=True).alias("ratio")]
    return _uneven(spark, sf).groupBy("region0", "returnflag").agg(*means).withColumns({c: F.round(c, 6) for c in ("mean", "ratio")})


@query("exact_totals", f"WITH {_UNEVEN}, c AS (SELECT region, year, fsum(value) AS value FROM u GROUP BY ALL) SELECT region, year, round(value, 6) AS value FROM c "
       "UNION ALL SELECT 'ALL', year, round(fsum(value), 6) FROM c GROUP BY year UNION ALL SELECT 'OLD', year, round(fsum(value), 6) FROM c WHERE region IN ('ASIA', 'EUROPE') GROUP BY year")
def exact_totals(spark, sf):
    cells = rollup.grouped_sum(_uneven(spark, sf), ["region", "year"], exact=True)
    totals = [(None, {"region": "ALL"}), ("region IN ('ASIA', 'EUROPE')", {"region": "OLD"})]
    return rollup.append_totals(cells, totals, "value", exact=True).withColumn("value", F.round("value", 6))


@query("sum_all_but", "SELECT scenario, linestatus, year, sum(value) AS \"Value\" FROM o_obs GROUP BY ALL")
def sum_all_but(spark, sf):
    cells = summed(spark, sf, "linestatus", by_region="region0", Value=F.col("value"))
    return rollup.sum_all_but(cells, "region0", "region")


@query("strict_null_sum", f"SELECT scenario, region, returnflag, {strict('hole')} AS total, sum(hole) AS known, count(*) AS n FROM "
       "(SELECT scenario, region, returnflag, CASE WHEN NOT (linenumber = 7 AND returnflag = 'N' AND scenario = '1-URGENT') THEN value END AS hole FROM o_obs) GROUP BY ALL")
def strict_null_sum(spark, sf):
    gap = (F.col("linenumber") == 7) & (F.col("returnflag") == "N") & (F.col("scenario") == "1-URGENT")
    facts = line_facts(spark, sf).withColumn("hole", F.when(~gap, F.col("value")))
    cells = facts.groupBy("scenario", "nationkey", "returnflag").agg(
        strict_sum("hole").alias("total"), F.sum("hole").alias("known"), F.count(F.lit(1)).alias("n")
    )
    return named(cells, spark, sf).groupBy("scenario", "region", "returnflag").agg(
        strict_sum("total").alias("total"), F.sum("known").alias("known"), F.sum("n").alias("n")
    )


@query("region_rollup_sum", "WITH c AS (SELECT scenario, region, year, sum(value) AS value FROM o_obs GROUP BY ALL) SELECT scenario, region, year, value FROM c UNION ALL "
       "SELECT scenario, code AS region, year, sum(value) AS value FROM c JOIN o_bridge ON member = region GROUP BY scenario, code, year")
def region_rollup_sum(spark, sf):
    cells = summed(spark, sf, value=F.col("value"))
    return rollup.region_rollup(cells, value="value", region="region", groups=GROUPS)


@query("region_rollup_wmean", "WITH c AS (SELECT scenario, region, year, returnflag, sum(value) / sum(weight) AS value, CASE WHEN returnflag = 'A' AND year = 1996 THEN 0 ELSE sum(weight) END AS weight "
       f"FROM o_obs GROUP BY scenario, region, year, returnflag) SELECT scenario, region, year, returnflag, round(value, 6) AS value FROM c UNION ALL SELECT scenario, code AS region, year, returnflag, round({wmean('value', 'weight')}, 6) "
       "FROM c JOIN o_bridge ON member = region GROUP BY scenario, code, year, returnflag")
def region_rollup_wmean(spark, sf):
    cells = summed(spark, sf, "returnflag")
    no_weight = (F.col("returnflag") == "A") & (F.col("year") == 1996)
    cells = cells.withColumns(
        {"value": F.try_divide("value", "weight"), "weight": F.when(no_weight, F.lit(0.0)).otherwise(F.col("weight"))}
    )
    rolled = rollup.region_rollup(cells, value="value", weight="weight", region="region", groups=GROUPS)
    return rolled.withColumn("value", F.round("value", 6))


@query("region_rollup_repeated_rows", "WITH c AS (SELECT scenario, region, year, sum(value) AS value FROM o_obs GROUP BY scenario, region0, region, year) SELECT scenario, region, year, value FROM c "
       "UNION ALL SELECT scenario, code AS region, year, sum(value) AS value FROM c JOIN o_bridge ON member = region GROUP BY scenario, code, year")
def region_rollup_repeated_rows(spark, sf):
    cells = summed(spark, sf, by_region="region0", value=F.col("value")).drop("region0")
    return rollup.region_rollup(cells, value="value", region="region", groups=GROUPS, repeated_rows=True)


@query("weighted_mean_with_weight", f"SELECT scenario, linestatus, year, round({wmean('linenumber::DOUBLE', 'weight')}, 6) AS mean, sum(weight) AS weight FROM "
       "(SELECT scenario, linestatus, year, linenumber, CASE WHEN linenumber = 3 THEN 0 ELSE weight END AS weight FROM o_obs) GROUP BY ALL")
def weighted_mean_with_weight(spark, sf):
    weight = F.when(F.col("linenumber") == 3, F.lit(0.0)).otherwise(F.col("weight"))
    facts = line_facts(spark, sf).withColumns({"weight": weight, "number": F.col("linenumber").cast("double")})
    return facts.groupBy("scenario", "linestatus", "year").agg(
        F.round(weighted_mean("number", "weight"), 6).alias("mean"), strict_sum("weight").alias("weight")
    )


@query("ratio_of_sums", "SELECT region, round(sum(a) / nullif(sum(a + r), 0), 9) AS share, round(1 + sum(a) / nullif(sum(w - a), 0), 9) AS scale FROM (SELECT region, weight AS w, CASE WHEN returnflag = 'A' "
       "THEN weight ELSE 0 END AS a, CASE WHEN returnflag = 'R' THEN weight ELSE 0 END AS r FROM o_obs) GROUP BY ALL")
def ratio_of_sums_query(spark, sf):
    flagged = lambda f: F.when(F.col("returnflag") == f, F.col("weight")).otherwise(F.lit(0.0))
    cells = line_facts(spark, sf).groupBy("nationkey").agg(
        F.sum(flagged("A")).alias("a"), F.sum(flagged("R")).alias("r"), F.sum("weight").alias("w")
    )
    shares = named(cells, spark, sf).withColumns({"both": F.col("a") + F.col("r"), "rest": F.col("w") - F.col("a")})
    return shares.groupBy("region").agg(
        F.round(ratio_of_sums("a", "both"), 9).alias("share"), F.round(ratio_of_sums("a", "rest") + 1, 9).alias("scale")
    )


@query("multi_measure_sums", "SELECT scenario, region, year, sum(value) AS intake, sum(value / 4) AS avail, sum(weight * 27) AS ar6, sum(weight * 28) AS ar5, sum(weight * 25) AS ar4 FROM o_obs GROUP BY ALL")
def multi_measure_sums(spark, sf):
    weight = F.col("weight")
    return summed(
        spark, sf, intake=F.col("value"), avail=F.col("value") / 4, ar6=weight * 27, ar5=weight * 28, ar4=weight * 25
    )


@query("append_total_item", "WITH c AS (SELECT scenario, linestatus, returnflag, year, sum(value) AS value FROM o_obs GROUP BY ALL) SELECT * FROM c UNION ALL "
       "SELECT scenario, linestatus, 'CRP' AS returnflag, year, sum(value) FROM c GROUP BY ALL")
def append_total_item(spark, sf):
    cells = summed(spark, sf, "linestatus", "returnflag", by_region=None, value=F.col("value"))
    return rollup.append_total(cells, "returnflag", "CRP", value="value")


@query("append_subset_total", "WITH c AS (SELECT scenario, linestatus, returnflag, year, sum(value) AS value FROM o_obs GROUP BY ALL) SELECT * FROM c UNION ALL "
       "SELECT scenario, linestatus, 'AGR' AS returnflag, year, sum(value) FROM c WHERE returnflag IN ('A', 'R') GROUP BY ALL UNION ALL "
       "SELECT scenario, 'ALL' AS linestatus, returnflag, year, sum(value) FROM c GROUP BY ALL")
def append_subset_total(spark, sf):
    cells = summed(spark, sf, "linestatus", "returnflag", by_region=None, value=F.col("value"))
    totals = [(rollup.members("returnflag", ["A", "R"]), {"returnflag": "AGR"}), (None, {"linestatus": "ALL"})]
    return rollup.append_totals(cells, totals, "value")


@query("year_span", "SELECT min(CAST(year(o_orderdate) AS INTEGER)) AS first_year, max(CAST(year(o_orderdate) AS INTEGER)) AS last_year FROM orders")
def year_span(spark, sf):
    return read(spark, sf, "orders").agg(F.year(F.min("o_orderdate")).alias("first_year"), F.year(F.max("o_orderdate")).alias("last_year"))


@query("distinct_members", "SELECT DISTINCT p_brand AS brand, p_type AS kind FROM part")
def distinct_members(spark, sf):
    return read(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind")).distinct()


# -- series ----------------------------------------------------------------------------------------

FRAGMENT_SERIES = "(SELECT scenario, region, year, sum(value) AS value FROM o_obs GROUP BY ALL)"


@query("change_ratio_first", f"SELECT scenario, region, year, value / nullif(first_value(value) OVER (PARTITION BY scenario, region ORDER BY year), 0) AS value FROM {FRAGMENT_SERIES}")
def change_ratio_first(spark, sf):
    return series.change_from_first(summed(spark, sf, value=F.col("value")), ["scenario", "region"], "year", "value")


@query("change_abs_first", f"SELECT scenario, region, year, value - first_value(value) OVER (PARTITION BY scenario, region ORDER BY year) AS value FROM {FRAGMENT_SERIES}")
def change_abs_first(spark, sf):
    return series.change_from_first(summed(spark, sf, value=F.col("value")), ["scenario", "region"], "year", "value", "abs")


@query("index_first_year", f"SELECT scenario, region, year, value, value / nullif(first_value(value) OVER (PARTITION BY scenario, region ORDER BY year), 0) AS \"Index\" FROM {FRAGMENT_SERIES}")
def index_first_year(spark, sf):
    return series.change_from_first(summed(spark, sf, value=F.col("value")), ["scenario", "region"], "year", "value", into="Index")


@query("index_base_year", f"SELECT scenario, region, year, value / nullif(max(CASE WHEN year = 1997 THEN value END) OVER (PARTITION BY scenario, region), 0) AS value FROM {FRAGMENT_SERIES}")
def index_base_year(spark, sf):
    return series.index_to_year(summed(spark, sf, value=F.col("value")), ["scenario", "region"], "year", "value", 1997)


@query("freeze_base_year", "SELECT scenario, region, year, CASE WHEN region = 'ASIA' THEN max(CASE WHEN year = 1998 THEN value END) OVER w ELSE max(CASE WHEN year = 1995 THEN value END) OVER w END AS value "
       f"FROM {FRAGMENT_SERIES} WINDOW w AS (PARTITION BY scenario, region)")
def freeze_base_year(spark, sf):
    cells = summed(spark, sf, value=F.col("value"))
    return series.freeze_at(cells, ["scenario", "region"], "year", "value", [(F.col("region") == "ASIA", 1998), (None, 1995)])


# Years 1995, 1998 and 2001 only; one scenario lacks the last year, another has a missing value.
_GAPPY = (
    "(SELECT scenario, region, year, CASE WHEN NOT (scenario = '2-HIGH' AND year = 1998) THEN sum(value) END AS value FROM o_obs "
    "WHERE year IN (1995, 1998, 2001) AND NOT (scenario = '5-LOW' AND year = 2001) GROUP BY scenario, region, year)"
)
_FILLED = (
    f"g AS {_GAPPY}, span AS (SELECT min(year) AS y0, max(year) AS y1 FROM g), "
    "m AS (SELECT CAST(unnest(range(y0, y1 + 1)) AS INTEGER) AS year FROM span), "
    "rows_all AS (SELECT scenario, region, year, value FROM g UNION ALL SELECT k.scenario, k.region, m.year, NULL FROM "
    "(SELECT scenario, region FROM g WHERE year = (SELECT y1 FROM span)) k CROSS JOIN m WHERE m.year NOT IN (SELECT year FROM g)), "
    "near AS (SELECT r.*, (SELECT max(year) FROM rows_all p WHERE p.scenario = r.scenario AND p.region = r.region AND p.year <= r.year AND p.value IS NOT NULL) AS ya, "
    "(SELECT min(year) FROM rows_all p WHERE p.scenario = r.scenario AND p.region = r.region AND p.year >= r.year AND p.value IS NOT NULL) AS yb FROM rows_all r), "
    "filled AS (SELECT n.scenario, n.region, n.year, CASE WHEN n.value IS NOT NULL THEN n.value WHEN ya IS NULL THEN b.value WHEN yb IS NULL THEN a.value "
    "ELSE a.value + (b.value - a.value) * ((n.year - ya) / (yb - ya)::DOUBLE) END AS value FROM near n "
    "LEFT JOIN g a ON a.scenario = n.scenario AND a.region = n.region AND a.year = ya LEFT JOIN g b ON b.scenario = n.scenario AND b.region = n.region AND b.year = yb)"
)


def _gappy(spark, sf):
    cells = summed(spark, sf, value=F.col("value")).where(
        F.col("year").isin(1995, 1998, 2001) & ~((F.col("scenario") == "5-LOW") & (F.col("year") == 2001))
    )
    hole = (F.col("scenario") == "2-HIGH") & (F.col("year") == 1998)
    return cells.withColumn("value", F.when(~hole, F.col("value")))


@query("annual_fill_linear", f"WITH {_FILLED} SELECT scenario, region, year, round(value, 4) AS value FROM filled")
def annual_fill_linear(spark, sf):
    return series.fill_annual(_gappy(spark, sf)).withColumn("value", F.round("value", 4))


@query("cumulative_step", f"WITH {_FILLED} SELECT scenario, region, year, value FROM (SELECT scenario, region, year, round(sum(value) OVER (PARTITION BY scenario, region ORDER BY year), 4) AS value "
       "FROM filled WHERE year >= 1996) WHERE (year - 1995) % 2 = 0")
def cumulative_step(spark, sf):
    return series.cumulate(_gappy(spark, sf), start=1996, step=2).withColumn("value", F.round("value", 4))


@query("pattern_from_column", "SELECT replace(p_name, split_part(p_name, ' ', 1), '') AS rest, split_part(p_name, ' ', 1) AS first, count(*) AS n FROM part GROUP BY ALL")
def pattern_from_column(spark, sf):
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    parts = read(spark, sf, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    cut = parts.withColumn("first", first).withColumn("rest", without_pattern_of(F.col("p_name"), F.col("first")))
    return cut.groupBy("rest", "first").agg(F.sum("n").alias("n"))


# -- shapes ----------------------------------------------------------------------------------------


@query("pivot_no_fill", "SELECT scenario, region, year, sum(value) FILTER (WHERE returnflag = 'A' AND year < 2000) AS A, sum(value) FILTER (WHERE returnflag = 'R' AND year < 2000) AS R, "
       "CAST(NULL AS DOUBLE) AS X FROM o_obs WHERE year < 2000 OR returnflag = 'N' GROUP BY scenario, region, year")
def pivot_no_fill(spark, sf):
    cells = summed(spark, sf, "returnflag", value=F.col("value")).where((F.col("year") < 2000) | (F.col("returnflag") == "N"))
    return reshape.pivot_wider(cells, ["scenario", "region", "year"], "returnflag", "value", ["A", "N", "R", "X"]).drop("N")


@query("pivot_fill_zero", "SELECT scenario, region, year, coalesce(sum(value) FILTER (WHERE returnflag = 'A' AND year <> 1997), 0) AS A, "
       "coalesce(sum(value) FILTER (WHERE returnflag = 'R'), 0) AS R FROM o_obs GROUP BY ALL")
def pivot_fill_zero(spark, sf):
    cells = summed(spark, sf, "returnflag", value=F.col("value"))
    cells = cells.where(~((F.col("returnflag") == "A") & (F.col("year") == 1997)))
    return reshape.pivot_wider(cells, ["scenario", "region", "year"], "returnflag", "value", ["A", "N", "R"], fill=0.0).drop("N")


@query("unpivot_measures", "SELECT scenario, region, year, 'value' AS \"Variable\", sum(value) AS \"Value\" FROM o_obs GROUP BY ALL UNION ALL "
       "SELECT scenario, region, year, 'weight', CASE WHEN year = 2001 THEN NULL ELSE sum(weight) END FROM o_obs GROUP BY scenario, region, year")
def unpivot_measures(spark, sf):
    cells = summed(spark, sf, amount=F.col("value"), weight=F.col("weight"))
    cells = cells.withColumn("weight", F.when(F.col("year") != 2001, F.col("weight"))).withColumnRenamed("amount", "value")
    renamed = cells.withColumnRenamed("value", "__v").withColumnRenamed("weight", "__w")
    return reshape.pivot_longer(renamed, ["__v", "__w"]).withColumn(
        "Variable", recode_values(F.col("Variable"), {"__v": "value", "__w": "weight"})
    )


@query("stock_loss", "SELECT scenario, region, year, A - R AS loss, N AS opening FROM (SELECT scenario, region, year, sum(weight) FILTER (WHERE returnflag = 'A') AS A, "
       "sum(weight) FILTER (WHERE returnflag = 'N') AS N, sum(weight) FILTER (WHERE returnflag = 'R') AS R FROM o_obs GROUP BY ALL)")
def stock_loss(spark, sf):
    cells = summed(spark, sf, "returnflag", value=F.col("weight"))
    wide = reshape.pivot_wider(cells, ["scenario", "region", "year"], "returnflag", "value", ["A", "N", "R"])
    return wide.select("scenario", "region", "year", (F.col("A") - F.col("R")).alias("loss"), F.col("N").alias("opening"))


@query("pivot_balance_identity", "SELECT scenario, region, year, cons, cons + R - F_ AS othr FROM (SELECT scenario, region, year, sum(value) FILTER (WHERE returnflag = 'A') - sum(value) FILTER (WHERE returnflag = 'N') AS cons, "
       "sum(value) FILTER (WHERE returnflag = 'R') AS R, sum(weight) AS F_ FROM o_obs GROUP BY ALL)")
def pivot_balance_identity(spark, sf):
    of = lambda f: F.when(F.col("returnflag") == f, F.col("value"))
    cells = summed(spark, sf, A=of("A"), N=of("N"), R=of("R"), food=F.col("weight"))
    return cells.select(
        "scenario", "region", "year", (F.col("A") - F.col("N")).alias("cons"), (F.col("cons") + F.col("R") - F.col("food")).alias("othr")
    )


@query("densify_items_zero", "WITH c AS (SELECT scenario, region, returnflag AS item, year, sum(value) AS value FROM o_obs WHERE NOT (returnflag = 'N' AND year <> 1995) GROUP BY ALL) "
       "SELECT k.scenario, k.region, i.item, k.year, coalesce(c.value, 0) AS value FROM (SELECT DISTINCT scenario, region, year FROM c) k CROSS JOIN (SELECT DISTINCT item FROM c) i "
       "LEFT JOIN c ON c.scenario = k.scenario AND c.region = k.region AND c.year = k.year AND c.item = i.item")
def densify_items_zero(spark, sf):
    cells = summed(spark, sf, F.col("returnflag").alias("item"), value=F.col("value"))
    return reshape.densify(cells.where(~((F.col("item") == "N") & (F.col("year") != 1995))), "item", "value", many=False)


_PART_SUMS = "c AS (SELECT l_returnflag AS returnflag, l_partkey AS part, sum(l_quantity) AS value FROM lineitem WHERE l_partkey % 7 <> 0 OR l_returnflag = 'R' GROUP BY ALL)"


def _part_sums(spark, sf):
    lines = read(spark, sf, "lineitem").where((F.col("l_partkey") % 7 != 0) | (F.col("l_returnflag") == "R"))
    return lines.groupBy(F.col("l_returnflag").alias("returnflag"), F.col("l_partkey").alias("part")).agg(F.sum("l_quantity").alias("value"))


@query("densify_parts_zero", f"WITH {_PART_SUMS} SELECT k.returnflag, p.part, coalesce(c.value, 0) AS value FROM (SELECT DISTINCT returnflag FROM c) k "
       "CROSS JOIN (SELECT DISTINCT part FROM c) p LEFT JOIN c ON c.returnflag = k.returnflag AND c.part = p.part")
def densify_parts_zero(spark, sf):
    """Members that grow with the data, met in blocks."""
    return reshape.densify(_part_sums(spark, sf), "part", "value", many=True)


@query("grid_complete_parts", f"WITH {_PART_SUMS}, g AS (SELECT CAST(n_nationkey % 3 AS INTEGER) AS lot, CAST(n_nationkey AS BIGINT) AS nation FROM nation), "
       "d AS (SELECT CAST(part % 3 AS INTEGER) AS lot, part % 25 AS nation, part, returnflag, value FROM c WHERE part % 2 = 0) "
       "SELECT lot, nation, part, returnflag, value FROM d JOIN g USING (lot, nation) UNION ALL SELECT g.lot, g.nation, o.part, o.returnflag, 0 FROM g CROSS JOIN (SELECT DISTINCT part, returnflag FROM d) o "
       "WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.lot = g.lot AND d.nation = g.nation)")
def grid_complete_parts(spark, sf):
    """Attribute combinations that grow with the data, met in blocks by the places without a row."""
    grid = read(spark, sf, "nation").select((F.col("n_nationkey") % 3).cast("int").alias("lot"), F.col("n_nationkey").cast("long").alias("nation"))
    sums = _part_sums(spark, sf).where(F.col("part") % 2 == 0)
    data = sums.select((F.col("part") % 3).cast("int").alias("lot"), (F.col("part") % 25).alias("nation"), "part", "returnflag", "value")
    return reshape.complete_grid(data, grid, ["lot", "nation"], "value", many=True)


@query("replicate_over_parts", "SELECT r_name AS region, l_partkey AS part FROM region CROSS JOIN (SELECT DISTINCT l_partkey FROM lineitem)")
def replicate_over_parts(spark, sf):
    keys = read(spark, sf, "region").select(F.col("r_name").alias("region"))
    return lookup.replicate_over_observed(keys, "part", read(spark, sf, "lineitem"), "l_partkey", many=True)


@query("densify_scenarios_zero", "WITH c AS (SELECT scenario, region, year, sum(value) AS value FROM o_obs WHERE scenario IN ('1-URGENT', '5-LOW') GROUP BY ALL) "
       "SELECT s.scenario, k.region, k.year, coalesce(c.value, 0) AS value FROM (SELECT DISTINCT region, year FROM c) k CROSS JOIN (SELECT DISTINCT o_orderpriority AS scenario FROM orders) s "
       "LEFT JOIN c ON c.scenario = s.scenario AND c.region = k.region AND c.year = k.year")
def densify_scenarios_zero(spark, sf):
    cells = summed(spark, sf, value=F.col("value")).where(F.col("scenario").isin("1-URGENT", "5-LOW"))
    return reshape.densify(cells, "scenario", "value", members=ALL_SCENARIOS)


_BASIN = (
    "d AS (SELECT region0 AS region, linestatus AS basin, returnflag AS facet, year, sum(value) / 1048576 AS value FROM o_obs "
    "WHERE (region0 <> 'NATION_3' OR linestatus = 'F') AND NOT (region0 = 'NATION_4' AND returnflag = 'N') GROUP BY ALL), "
    "g AS (SELECT n_name AS region, b.basin FROM nation CROSS JOIN (SELECT DISTINCT l_linestatus AS basin FROM lineitem) b WHERE n_name <> 'NATION_9'), "
    "full_grid AS (SELECT d.region, d.basin, d.facet, d.year, d.value FROM d JOIN g USING (region, basin) UNION ALL "
    "SELECT w.region, w.basin, w.facet, o.year, 0 FROM (SELECT g.region, g.basin, f.facet FROM g CROSS JOIN (SELECT DISTINCT facet FROM d) f) w "
    "CROSS JOIN (SELECT DISTINCT year FROM d) o WHERE (w.region, w.basin, w.facet) NOT IN (SELECT region, basin, facet FROM d))"
)


def _basins(spark, sf):
    cells = summed(spark, sf, F.col("linestatus").alias("basin"), F.col("returnflag").alias("facet"), by_region="region0", value=F.col("value"))
    place = F.col("region0")
    kept = cells.where(((place != "NATION_3") | (F.col("basin") == "F")) & ~((place == "NATION_4") & (F.col("facet") == "N")))
    data = kept.groupBy(place.alias("region"), "basin", "facet", "year").agg((F.sum("value") / 1048576).alias("value"))
    # Small sums used twice: written once, so that the line items are read once.
    data = write_and_read_back(data, fresh_folder(spark))
    places = nations(spark, sf).where(F.col("region0") != "NATION_9").select(F.col("region0").alias("region"))
    grid = lookup.replicate_over_observed(places, "basin", data, "basin")
    return data, grid


@query("grid_complete_zero", f"WITH {_BASIN} SELECT region, basin, facet, year, value FROM full_grid")
def grid_complete_zero(spark, sf):
    data, grid = _basins(spark, sf)
    return reshape.complete_grid(data, grid, ["region", "basin"], "value", "facet", many=False)


@query("basin_map_classes", f"WITH {_BASIN}, e AS (SELECT floor(min(value) * 10) / 10 AS lo, ceil(max(value) * 10) / 10 AS hi FROM full_grid), "
       "b AS (SELECT list_sort(list_distinct(list(round_even(lo + k * ((hi - lo) / 5.0::DOUBLE), 1)))) AS breaks FROM e, (SELECT unnest(range(6)) AS k)) "
       "SELECT region, basin, facet, year, CASE WHEN pos BETWEEN 1 AND len(breaks) - 1 THEN '(' || replace((breaks[pos]::DECIMAL(18, 1))::VARCHAR || ',', '.0,', ',') || replace((breaks[pos + 1]::DECIMAL(18, 1))::VARCHAR || ']', '.0]', ']') END AS value "
       "FROM (SELECT f.*, breaks, len([x FOR x IN breaks IF x < f.value]) AS pos FROM full_grid f, b)")
def basin_map_classes(spark, sf):
    data, grid = _basins(spark, sf)
    return basin_map(data, grid, "facet", breaks=5)


@query("split_code", "SELECT parts[1] AS \"LandLeaf\", parts[2] AS \"Basin\", parts[3] AS \"IRR\", parts[4] AS \"MGMT\", p_name, CAST(sum(n) AS BIGINT) AS n FROM (SELECT regexp_split_to_array(p_name, '[^A-Za-z0-9]+') AS parts, p_name, count(*) AS n "
       "FROM part GROUP BY ALL) GROUP BY ALL")
def split_code(spark, sf):
    names = read(spark, sf, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    return reshape.split_code(names, "p_name", ["LandLeaf", "Basin", "IRR", "MGMT"], keep=True)


# -- set operations --------------------------------------------------------------------------------


@query("union_missing_columns", "SELECT scenario, year, sum(value) AS value, CAST(NULL AS DOUBLE) AS weight FROM o_obs GROUP BY ALL UNION ALL SELECT scenario, CAST(NULL AS INTEGER), NULL, sum(weight) FROM o_obs GROUP BY scenario")
def union_missing_columns(spark, sf):
    cells = line_facts(spark, sf).groupBy("scenario", "year").agg(F.sum("value").alias("value"), F.sum("weight").alias("weight"))
    cells = write_and_read_back(cells, fresh_folder(spark))
    by_year = cells.drop("weight")
    by_scenario = cells.groupBy("scenario").agg(F.sum("weight").alias("weight"))
    return reshape.union_all([by_year, by_scenario])


@query("key_set_difference", "SELECT DISTINCT l_partkey AS partkey, l_suppkey AS suppkey FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def key_set_difference(spark, sf):
    pairs = read(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"), "l_returnflag")
    sold, back = (pairs.where(F.col("l_returnflag") == f) for f in ("A", "R"))
    return reshape.key_difference(sold, back, ["partkey", "suppkey"])


# -- scalar functions ------------------------------------------------------------------------------


@query("text_recodes", "SELECT regexp_replace(lower(p_brand), 'brand#', '', 'g') || '_' || lower(p_type) AS label, regexp_matches(p_name, '^(red|blue)') AS coloured, count(*) AS n FROM part GROUP BY ALL")
def text_recodes(spark, sf):
    label = F.concat(without(F.lower("p_brand"), "brand#"), F.lit("_"), F.lower("p_type"))
    return read(spark, sf, "part").groupBy(label.alias("label"), matches(F.col("p_name"), "^(red|blue)").alias("coloured")).agg(F.count(F.lit(1)).alias("n"))


_USE_LABEL = ("'regional ' || p_type || '_' || CASE p_size % 5 WHEN 0 THEN 'NonFoodDemand_x' WHEN 1 THEN 'FoodDemand_y' "
              "WHEN 2 THEN 'FeedCrops' WHEN 3 THEN 'biomassOil' ELSE 'Stock' END")


@query("recode_use_class", f"SELECT element, sector, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(label, 'NonFoodDemand') THEN 'Other use' WHEN regexp_matches(label, 'ethanol|biomassOil') THEN 'Bioenergy' "
       "WHEN regexp_matches(label, 'FoodDemand') THEN 'Food' WHEN regexp_matches(label, 'FeedCrops|Fodder') THEN 'Feed' ELSE label END AS element, regexp_replace(label, 'regional |_', '', 'g') AS sector "
       f"FROM (SELECT {_USE_LABEL} AS label FROM part)) GROUP BY ALL")
def recode_use_class(spark, sf):
    kind = F.col("p_size") % 5
    use = F.when(kind == 0, "NonFoodDemand_x").when(kind == 1, "FoodDemand_y").when(kind == 2, "FeedCrops").when(kind == 3, "biomassOil").otherwise("Stock")
    labelled = read(spark, sf, "part").select(F.concat(F.lit("regional "), F.col("p_type"), F.lit("_"), use).alias("label"))
    return labelled.groupBy(
        recode_first_match(F.col("label"), USE_CLASSES).alias("element"), without(F.col("label"), "regional |_").alias("sector")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("trade_partner_text", "SELECT n_name AS partner, p_type AS sector, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey GROUP BY ALL")
def trade_partner_text(spark, sf):
    suppliers = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nationkey"))
    parts = read(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("sector"))
    # Summed before each join: a hot supplier or part enters it as a few rows.
    lines = read(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    sold = lines.join(suppliers, "l_suppkey").groupBy("nationkey", "l_partkey").agg(F.sum("n").alias("n"))
    traded = sold.join(parts, "l_partkey").groupBy("nationkey", "sector").agg(F.sum("n").alias("n"))
    labelled = named(traded, spark, sf).withColumn("subsector", F.concat("region0", F.lit(" traded "), "sector"))
    return labelled.select(trade_partner(F.col("subsector"), F.col("sector")).alias("partner"), "sector", "n")


@query("mixed_unit_convert", "SELECT scenario, year, round(sum(CASE WHEN returnflag = 'A' THEN weight * 1e9 / 17.5::DOUBLE / 1e6 ELSE weight END), 6) AS mt, round(sum(weight) * 44 / 12, 6) AS co2 FROM o_obs WHERE returnflag <> 'N' GROUP BY ALL")
def mixed_unit_convert(spark, sf):
    cells = summed(spark, sf, "returnflag", by_region=None, weight=F.col("weight")).where(F.col("returnflag") != "N")
    mass = F.when(F.col("returnflag") == "A", ej_to_mt(F.col("weight"))).otherwise(F.col("weight"))
    return cells.groupBy("scenario", "year").agg(
        F.round(F.sum(mass), 6).alias("mt"), F.round(carbon_to_co2(F.sum("weight")), 6).alias("co2")
    )


@query("deflate_series", "SELECT scenario, year, round(sum(value) * (1.0::DOUBLE / 0.25), 6) AS real FROM o_obs GROUP BY ALL")
def deflate_series(spark, sf):
    cells = summed(spark, sf, by_region=None, value=F.col("value"))
    return cells.select("scenario", "year", F.round(deflate(F.col("value"), lb.PRICE_LEVELS, 2015, 1975), 6).alias("real"))


@query("bin_right_closed", "WITH c AS (SELECT partkey, avg(weight) / 8 AS v FROM o_obs GROUP BY ALL), e AS (SELECT floor(min(v) * 10) / 10 AS lo, ceil(max(v) * 10) / 10 AS hi FROM c), "
       "b AS (SELECT list_sort(list_distinct(list(round_even(lo + k * ((hi - lo) / 4.0::DOUBLE), 1)))) AS breaks FROM e, (SELECT unnest(range(5)) AS k)) "
       "SELECT CAST(pos AS INTEGER) AS class, count(*) AS n FROM (SELECT CASE WHEN pos BETWEEN 1 AND len(breaks) - 1 THEN pos END AS pos FROM (SELECT breaks, len([x FOR x IN breaks IF x < v]) AS pos FROM c, b)) GROUP BY ALL")
def bin_right_closed(spark, sf):
    lines = read(spark, sf, "lineitem").groupBy("l_partkey").agg((F.avg("l_quantity") / 8).alias("v"))
    edges = lines.agg(rounded_breaks(F.min("v"), F.max("v"), 4)).scalar()
    classed = lines.withColumn("breaks", edges).withColumn("label", right_closed_label(F.col("v"), F.col("breaks"), 4))
    place = F.when(F.col("label").isNotNull(), class_index(F.col("v"), F.col("breaks"), 4))
    return classed.groupBy(place.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("class_by_threshold", "SELECT scenario, region, CASE WHEN value < 3000000000 / 40 THEN 'Mitigation' WHEN value >= 3000000000 / 40 THEN 'No Policy' END AS class, value FROM (SELECT scenario, region, sum(value) AS value FROM o_obs GROUP BY ALL)")
def class_by_threshold(spark, sf):
    cells = summed(spark, sf, value=F.col("value")).groupBy("scenario", "region").agg(F.sum("value").alias("value"))
    return cells.withColumn("class", class_below(F.col("value"), 3e9 / 40, "Mitigation", "No Policy"))


# -- pieces of the indicators ----------------------------------------------------------------------


@query("yield_ratio", "SELECT scenario, region, year, coalesce(value / nullif(area, 0), 0) AS rate FROM (SELECT scenario, region, year, sum(value) AS value, sum(CASE WHEN region = 'ASIA' AND year = 1996 THEN 0 ELSE weight END) AS area FROM o_obs GROUP BY scenario, region, year)")
def yield_ratio(spark, sf):
    cells = summed(spark, sf)
    area = F.when((F.col("region") == "ASIA") & (F.col("year") == 1996), F.lit(0.0)).otherwise(F.col("weight"))
    return cells.select("scenario", "region", "year", F.coalesce(F.try_divide(F.col("value"), area), F.lit(0.0)).alias("rate"))


@query("effect_pct_weighted", f"SELECT region, year, round({wmean('(A / nullif(N, 0) - 1) * 100', 'w')}, 6) AS effect, sum(w) AS weight FROM (SELECT region0, region, year, sum(value) FILTER (WHERE returnflag = 'A') AS A, "
       "sum(value) FILTER (WHERE returnflag = 'N') AS N, sum(weight) AS w FROM o_obs GROUP BY region0, region, year) GROUP BY region, year")
def effect_pct_weighted(spark, sf):
    of = lambda f: F.sum(F.when(F.col("returnflag") == f, F.col("value")))
    cells = line_facts(spark, sf).groupBy("nationkey", "year").agg(of("A").alias("A"), of("N").alias("N"), F.sum("weight").alias("w"))
    cells = named(cells, spark, sf).withColumn("effect", (F.try_divide("A", "N") - 1) * 100)
    return cells.groupBy("region", "year").agg(F.round(weighted_mean("effect", "w"), 6).alias("effect"), strict_sum("w").alias("weight"))


@query("scenario_source_switch", "SELECT scenario, region0, year, sum(CASE WHEN scenario IN ('2-HIGH', '3-MEDIUM') THEN weight ELSE value END) AS value FROM o_obs GROUP BY ALL")
def scenario_source_switch(spark, sf):
    cells = summed(spark, sf, by_region="region0")
    diet = ["2-HIGH", "3-MEDIUM"]
    own = cells.where(F.col("scenario").isin(diet)).select("scenario", "region0", "year", F.col("weight").alias("value"))
    rest = cells.where(~among(F.col("scenario"), diet)).select("scenario", "region0", "year", "value")
    return rollup.series_sum(reshape.union_all([own, rest]), "region0")


@query("conditional_divisor", "SELECT scenario, region, round(sum(value / (1 - CASE WHEN scenario IN ('2-HIGH', '5-LOW') THEN 0.125::DOUBLE ELSE 0.25::DOUBLE END)), 4) AS avail FROM (SELECT scenario, region, sum(value) AS value FROM o_obs GROUP BY ALL) GROUP BY ALL")
def conditional_divisor(spark, sf):
    cells = summed(spark, sf, value=F.col("value")).groupBy("scenario", "region").agg(F.sum("value").alias("value"))
    share = F.when(among(F.col("scenario"), ["2-HIGH", "5-LOW"]), F.lit(0.125)).otherwise(F.lit(0.25))
    return cells.select("scenario", "region", F.round(F.try_divide(F.col("value"), 1 - share), 4).alias("avail"))


@query("per_capita_day", "SELECT scenario, region, year, round(weight / 365 / people * 1e6, 4) AS daily FROM (SELECT scenario, region, year, sum(weight) AS weight FROM o_obs GROUP BY ALL) "
       "JOIN (SELECT r_name AS region, count(*)::DOUBLE AS people FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL) USING (region)")
def per_capita_day(spark, sf):
    people = named(read(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n")), spark, sf)
    people = people.groupBy("region").agg(F.sum("n").cast("double").alias("people"))
    cells = lookup.strict_lookup(summed(spark, sf), people, "region", ["people"], unique=True, what="population")
    return cells.select("scenario", "region", "year", F.round(per_person_and_day(F.col("weight"), F.col("people")), 4).alias("daily"))


@query("residual_sector", f"SELECT t.scenario, t.year, t.total - s.known AS residual FROM (SELECT scenario, year, sum(weight) AS total FROM o_obs GROUP BY ALL) t LEFT JOIN "
       "(SELECT scenario, year, sum(weight) AS known FROM o_obs WHERE returnflag <> 'N' AND year <> 1998 GROUP BY ALL) s USING (scenario, year)")
def residual_sector(spark, sf):
    known = F.when((F.col("returnflag") != "N") & (F.col("year") != 1998), F.col("weight"))
    cells = summed(spark, sf, by_region=None, total=F.col("weight"), known=known)
    return cells.select("scenario", "year", (F.col("total") - F.col("known")).alias("residual"))


@query("strict_sum_of_part", f"SELECT region, {strict_where('linestatus = ' + chr(39) + 'F' + chr(39), 'CASE WHEN NOT (linenumber = 7 AND region = ' + chr(39) + 'ASIA' + chr(39) + ') THEN weight END')} AS part, count(*) AS n FROM o_obs GROUP BY ALL")
def strict_sum_of_part(spark, sf):
    asia = nations(spark, sf)
    cells = line_facts(spark, sf).groupBy("nationkey", "linestatus", (F.col("linenumber") == 7).alias("last")).agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")
    )
    cells = lookup.strict_lookup(cells, asia, "nationkey", ["region"], what="nation")
    hole = F.when(~(F.col("last") & (F.col("region") == "ASIA")), F.col("weight"))
    return cells.groupBy("region").agg(strict_sum_where(F.col("linestatus") == "F", hole).alias("part"), F.sum("n").alias("n"))
