"""Catalogue, raw exports, stored tables and report files, with trees written from the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.operators.lookup import lookup_matched, strict_lookup
from cropledger.operators.reshape import pivot_wider, union_all
from cropledger.session import fresh_folder, remove_folder, write_and_read_back
from cropledger.sources import catalog as cat
from cropledger.sources.dims import default_dimensions, read_auxiliary, read_dimension
from cropledger.sources.store import Store, load_exports
from cropledger.star import labels as lb
from cropledger.star.facts import line_facts, nations, summed
from cropledger.star.model import StarModel, pick, read
from cropledger.star.registry import query

PROJECT, VERSION = "star", "v1"
YEARS = [str(y) for y in range(1995, 2002)]


def _folder_name(scenario: str) -> str:
    return scenario.replace(" ", "_")


def _wide(spark, sf, measure: str) -> DataFrame:
    """One row per scenario, region and flag, one column per year, scenario dated as in raw exports."""
    cells = summed(spark, sf, "returnflag", value=F.col(measure)).withColumn("year", F.col("year").cast("string"))
    wide = pivot_wider(cells, ["scenario", "region", "returnflag"], "year", "value", YEARS)
    return wide.withColumn("Units", F.lit("Mt"))


def write_tree(spark: SparkSession, sf: str, root: str) -> None:
    """``root/star/v1/<scenario>/<query>.csv`` as folders of part files, one write per scenario and query."""
    for query_name, measure in (("money", "value"), ("mass", "weight")):
        wide = write_and_read_back(_wide(spark, sf, measure), f"{root}-{query_name}")
        for scenario in lb.SCENARIO_OF:
            rows = wide.where(F.col("scenario") == scenario)
            dated = F.concat("scenario", F.lit(",date=2024-7-1"))
            rows = rows.select(dated.alias("scenario"), "region", "returnflag", *YEARS, "Units")
            target = f"{root}/{PROJECT}/{VERSION}/{_folder_name(scenario)}/{query_name}.csv"
            rows.write.mode("overwrite").option("header", "true").csv(target)


_COMPLETE = (
    "WITH c AS (SELECT scenario, region, returnflag, year, sum({m}) AS value FROM o_obs GROUP BY ALL), "
    "k AS (SELECT scenario, region, returnflag FROM c GROUP BY ALL HAVING count(*) = 7) "
)


@query("csv_tree_roundtrip", _COMPLETE.format(m="value") + "SELECT scenario, region, returnflag, year, value, 'Mt' AS \"Units\", replace(scenario, ' ', '_') AS ss FROM c JOIN k USING (scenario, region, returnflag)")
def csv_tree_roundtrip(spark, sf):
    root = fresh_folder(spark)
    write_tree(spark, sf, f"{root}/raw")
    store = Store(spark, f"{root}/tables")
    load_exports(spark, f"{root}/raw", PROJECT, store, versions=[VERSION])
    return store.load("money", versions=[VERSION]).drop("version", "scen")


@query("csv_tree_selection", _COMPLETE.format(m="weight") + "SELECT scenario, sum(value) AS value, count(*) AS n FROM c JOIN k USING (scenario, region, returnflag) "
       "WHERE scenario IN ('1-URGENT', '4-NOT SPECIFIED') GROUP BY ALL")
def csv_tree_selection(spark, sf):
    root = fresh_folder(spark)
    write_tree(spark, sf, f"{root}/raw")
    store = Store(spark, f"{root}/tables")
    load_exports(spark, f"{root}/raw", PROJECT, store, scens=["1-URGENT", "4-NOT_SPECIFIED"], queries=["mass"])
    rows = store.load("mass", scens=["1-URGENT", "4-NOT_SPECIFIED"])
    return rows.groupBy("scenario").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))


@query("catalog_listing", "SELECT DISTINCT 'v1' AS version, replace(o_orderpriority, ' ', '_') AS scen, q AS query FROM orders CROSS JOIN (VALUES ('mass'), ('money')) AS v(q)")
def catalog_listing(spark, sf):
    root = fresh_folder(spark)
    write_tree(spark, sf, root)
    listed = cat.list_exports(spark, root, PROJECT)
    return cat.select_exports(listed, in_versions=[VERSION]).select("version", "scen", "query").distinct()


@query("stored_table", "SELECT scenario, region, year, sum(value) AS value FROM o_obs WHERE scenario IN ('2-HIGH', '5-LOW') GROUP BY ALL")
def stored_table(spark, sf):
    store = Store(spark, fresh_folder(spark))
    cells = summed(spark, sf, value=F.col("value"))
    store.save("cells", cells.withColumns({"version": F.lit(VERSION), "scen": F.col("scenario")}), ["version", "scen"])
    return store.load("cells", versions=[VERSION], scens=["2-HIGH", "5-LOW"]).drop("version", "scen")


@query("append_to_stored_set", "WITH c AS (SELECT scenario, region, year, sum(value) AS value FROM o_obs GROUP BY ALL) SELECT 'v1' AS version, scenario AS scen, region, year, value FROM c "
       "WHERE scenario IN ('1-URGENT', '3-MEDIUM') UNION ALL SELECT 'v1', scenario, region, year, -value FROM c WHERE scenario = '2-HIGH' UNION ALL SELECT 'v2', scenario, region, year, value FROM c WHERE scenario = '2-HIGH'")
def append_to_stored_set(spark, sf):
    """A named set grows by saving more of it: partitions that come again replace theirs, the others stay."""
    store = Store(spark, fresh_folder(spark))
    cells = write_and_read_back(summed(spark, sf, value=F.col("value")).withColumnRenamed("scenario", "scen"), fresh_folder(spark))
    high = cells.where(F.col("scen") == "2-HIGH")
    more = [("v1", cells.where(F.col("scen").isin("1-URGENT", "2-HIGH"))), ("v1", high.withColumn("value", -F.col("value"))), ("v2", high),
            ("v1", cells.where(F.col("scen") == "3-MEDIUM"))]
    for version, rows in more:
        store.save("cells", rows.withColumn("version", F.lit(version)), ["version", "scen"])
    return store.load("cells")


@query("dimension_from_csv", "SELECT region, count(*) AS n FROM o_obs JOIN nation ON n_name = region0 WHERE n_nationkey < 20 GROUP BY ALL")
def dimension_from_csv(spark, sf):
    """A mapping file written from the nation table, read back with its key checked."""
    path = f"{fresh_folder(spark)}/map.csv"
    shown = nations(spark, sf).select(F.col("nationkey").alias("Nation ID"), F.when(F.col("nationkey") < 20, F.col("region")).alias("Report region"))
    shown.write.option("header", "true").csv(path)
    dim = read_dimension(spark, path, {"nationkey": "Nation ID", "region": "Report region"}, ["nationkey"], types={"nationkey": "int"})
    cells = line_facts(spark, sf).groupBy("nationkey").agg(F.count(F.lit(1)).alias("n"))
    return lookup_matched(cells, dim, "nationkey", ["region"], unique=True).groupBy("region").agg(F.sum("n").alias("n"))


@query("auxiliary_table", "SELECT region_id, CAST(year AS INTEGER) AS year, value FROM t_force")
def auxiliary_table(spark, sf):
    path = f"{fresh_folder(spark)}/labour"
    force = StarModel(spark, sf).table("labour_force").where(F.col("scenario") == "ssp2")
    force.select(F.col("region_id").alias("ID"), "year", "value").write.parquet(path)
    return read_auxiliary(spark, path, "region_id int, year int, value double", {"region_id": "ID"})


@query("fixed_dimensions", "SELECT l.cover, l.item, count(*) AS n, sum(l_quantity) AS weight FROM lineitem JOIN (SELECT *, row_number() OVER (ORDER BY \"LandLeaf\") - 1 AS p FROM f_leaves) l "
       "ON l.p = l_partkey % 43 GROUP BY ALL")
def fixed_dimensions(spark, sf):
    leaf = pick(lb.LEAVES, (F.col("l_partkey") % lb.N_LEAVES).cast("int"))
    lines = read(spark, sf, "lineitem").groupBy(leaf.alias("LandLeaf")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("weight")
    )
    leaves = default_dimensions(spark).leaves
    named = strict_lookup(lines, leaves, "LandLeaf", ["cover"], unique=True, what="leaves").join(leaves.select("LandLeaf", "item"), "LandLeaf")
    return named.groupBy("cover", "item").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))


# -- exports with faults, several headers, odd paths, changes ---------------------------------------

EARLY, LATE = YEARS[:4], YEARS[4:]


def _line(*cells) -> Column:
    """A line of a raw export; an absent cell is blank."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells])


def _dated() -> Column:
    return F.concat(F.lit('"'), "scenario", F.lit(',date=2024-7-1"'))


def _write_lines(lines: DataFrame, target: str) -> None:
    """Lines in the order of ``block`` and ``line`` as one raw export."""
    raw = lines.coalesce(1).sortWithinPartitions("block", "line").select("line")
    raw.write.mode("overwrite").option("quote", "\0").option("sep", "\1").csv(target)


def _block(spark: SparkSession, rows: DataFrame, number: int, header: str, line: Column) -> DataFrame:
    """A title, a header and lines; sorted by the block's number, title and header come first."""
    top = spark.createDataFrame([(f"{number}a", "Table of cells"), (f"{number}b", header)], "block string, line string")
    return top.unionByName(rows.select(F.lit(f"{number}c").alias("block"), line.alias("line")))


@query(
    "csv_tree_mixed_headers",
    "WITH c AS (SELECT scenario, region, returnflag, year, sum(weight) AS value FROM o_obs GROUP BY ALL), "
    "k AS (SELECT scenario, region, returnflag, early FROM (SELECT *, year < 1999 AS early FROM c) GROUP BY scenario, region, returnflag, early "
    "HAVING count(*) = CASE WHEN early THEN 4 ELSE 3 END) "
    "SELECT c.scenario, c.region, c.returnflag, year, value, 'Mt' AS \"Units\", replace(c.scenario, ' ', '_') AS ss FROM c "
    "JOIN k ON k.scenario = c.scenario AND k.region = c.region AND k.returnflag = c.returnflag AND k.early = (c.year < 1999)",
)
def csv_tree_mixed_headers(spark, sf):
    """Each export has two blocks, the second with other years and its columns in another order."""
    root = fresh_folder(spark)
    wide = write_and_read_back(_wide(spark, sf, "weight"), f"{root}/wide")
    for scenario in lb.SCENARIO_OF:
        rows = wide.where(F.col("scenario") == scenario)
        early = _line(_dated(), F.col("region"), F.col("returnflag"), *map(F.col, EARLY), F.lit("Mt"), F.lit(""))
        late = _line(_dated(), F.lit("Mt"), *map(F.col, LATE), F.col("returnflag"), F.col("region"))
        blocks = [
            _block(spark, rows, 1, f"scenario,region,returnflag,{','.join(EARLY)},Units,", early),
            _block(spark, rows, 2, f"scenario,Units,{','.join(LATE)},returnflag,region", late),
        ]
        _write_lines(union_all(blocks), f"{root}/raw/{PROJECT}/{VERSION}/{_folder_name(scenario)}/mass.csv")
    store = Store(spark, f"{root}/tables")
    load_exports(spark, f"{root}/raw", PROJECT, store)
    return store.load("mass").drop("version", "scen")


@query(
    "load_rejects",
    "WITH c AS (SELECT scenario, region, returnflag, year, sum(weight) AS value FROM o_obs GROUP BY ALL), "
    "k AS (SELECT scenario, region, returnflag, count(*) = 7 AS whole FROM c GROUP BY ALL), "
    "r AS (SELECT scenario, CASE WHEN region = 'ASIA' THEN 'too many cells' WHEN region = 'AFRICA' THEN 'too few cells' WHEN NOT whole THEN 'blank cell' "
    "WHEN returnflag = 'N' THEN 'no number' END AS reason FROM k) "
    "SELECT 'mass' AS query, replace(scenario, ' ', '_') AS scen, reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL "
    "UNION ALL SELECT 'empty', replace(scenario, ' ', '_'), 'no readable export', 1 FROM (SELECT DISTINCT scenario FROM c)",
)
def load_rejects(spark, sf):
    """What a load leaves out, by export and reason: lines of the wrong length, blank cells, cells that are no numbers."""
    root = fresh_folder(spark)
    wide = write_and_read_back(_wide(spark, sf, "weight"), f"{root}/wide")
    header = f"scenario,region,returnflag,{','.join(YEARS)},Units"
    # A row without 1997 is left out for its blank cell; others of one flag have a word there.
    word = F.when((F.col("returnflag") == "N") & F.col("1997").isNotNull(), F.lit("none")).otherwise(F.col("1997").cast("string"))
    whole = _line(_dated(), F.col("region"), F.col("returnflag"), *[word if y == "1997" else F.col(y) for y in YEARS], F.lit("Mt"))
    line = (
        F.when(F.col("region") == "ASIA", F.concat(whole, F.lit(",9")))
        .when(F.col("region") == "AFRICA", _line(_dated(), F.col("region"), F.col("returnflag")))
        .otherwise(whole)
    )
    for scenario in lb.SCENARIO_OF:
        folder = f"{root}/raw/{PROJECT}/{VERSION}/{_folder_name(scenario)}"
        rows = wide.where(F.col("scenario") == scenario)
        _write_lines(_block(spark, rows, 1, header, line), f"{folder}/mass.csv")
        _write_lines(spark.createDataFrame([("1", "no table here")], "block string, line string"), f"{folder}/empty.csv")
    store = Store(spark, f"{root}/tables")
    load_exports(spark, f"{root}/raw", PROJECT, store)
    found = [
        store.load("rejected_files").select("query", "path", "reason"), store.load("rejected_rows").select("query", "path", "reason"),
        store.load("rejected_cells").select("query", "path", F.lit("no number").alias("reason")),
    ]
    parts = F.split("path", "/")
    return union_all(found).groupBy("query", F.element_at(parts, -3).alias("scen"), "reason").agg(F.count(F.lit(1)).alias("n"))


@query("csv_tree_special_paths", _COMPLETE.format(m="weight") + "SELECT scenario, region, returnflag, year, value, scenario || ' +50%25[a]{b,c}' AS ss FROM c JOIN k USING (scenario, region, returnflag)")
def csv_tree_special_paths(spark, sf):
    """Scenario folders named with blanks, plus signs, percent escapes, brackets and braces."""
    root = fresh_folder(spark)
    wide = write_and_read_back(_wide(spark, sf, "weight"), f"{root}/wide")
    odd = {s: f"{s} +50%25[a]{{b,c}}" for s in lb.SCENARIO_OF}
    for scenario, folder in odd.items():
        wide.where(F.col("scenario") == scenario).write.option("header", "true").csv(f"{root}/raw/{PROJECT}/{VERSION}/{folder}/mass.csv")
    store = Store(spark, f"{root}/tables")
    load_exports(spark, f"{root}/raw", PROJECT, store, scens=list(odd.values()), queries=["mass"])
    return store.load("mass", scens=list(odd.values())).drop("version", "scen", "Units")


@query(
    "csv_tree_second_load",
    "WITH c AS (SELECT scenario, region, returnflag, year, sum(weight) AS weight, sum(value) AS value FROM o_obs GROUP BY ALL), "
    "k AS (SELECT scenario, region, returnflag FROM c GROUP BY ALL HAVING count(*) = 7), w AS (SELECT * FROM c JOIN k USING (scenario, region, returnflag)) "
    "SELECT 'v1' AS version, scenario, region, returnflag, year, weight AS value FROM w WHERE scenario NOT IN ('2-HIGH', '5-LOW') "
    "UNION ALL SELECT 'v1', scenario, region, returnflag, year, value FROM w WHERE scenario = '2-HIGH' AND returnflag = 'R' "
    "UNION ALL SELECT 'v2', scenario, region, returnflag, year, value FROM w WHERE scenario = '3-MEDIUM'",
)
def csv_tree_second_load(spark, sf):
    """Between two loads one export changes, one goes and one comes; only what changed or came is read again."""
    root = fresh_folder(spark)
    tree = f"{root}/raw/{PROJECT}"
    weight, value = (write_and_read_back(_wide(spark, sf, m), f"{root}/{m}") for m in ("weight", "value"))

    def export(rows: DataFrame, version: str, scenario: str) -> None:
        own = rows.where(F.col("scenario") == scenario)
        own.write.mode("overwrite").option("header", "true").csv(f"{tree}/{version}/{_folder_name(scenario)}/cells.csv")

    for scenario in lb.SCENARIO_OF:
        export(weight, "v1", scenario)
    store = Store(spark, f"{root}/tables")
    load_exports(spark, f"{root}/raw", PROJECT, store)
    export(value.where(F.col("returnflag") == "R"), "v1", "2-HIGH")
    export(value, "v2", "3-MEDIUM")
    remove_folder(spark, f"{tree}/v1/{_folder_name('5-LOW')}")
    load_exports(spark, f"{root}/raw", PROJECT, store)
    return store.load("cells").drop("scen", "ss", "Units")
