"""Line facts under their own labels, for the operator queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.operators.lookup import strict_lookup
from cropledger.star.model import read
from cropledger.star.sql import FRAGMENTS

WORLD = "WLD"
GROUPS = {"AMEU": ["AMERICA", "EUROPE"], "ASME": ["ASIA", "MIDDLE EAST"]}

FRAGMENTS["o_obs"] = (
    "SELECT o_orderpriority AS scenario, n_name AS region0, r_name AS region, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "l_partkey AS partkey, l_linestatus AS linestatus, l_returnflag AS returnflag, round(l_extendedprice * 100) AS value, "
    "l_quantity AS weight, l_linenumber AS linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey "
    "JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
)
FRAGMENTS["o_parts"] = "SELECT p_partkey AS partkey, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size FROM part"
FRAGMENTS["o_bridge"] = (
    "SELECT 'WLD' AS code, r_name AS member FROM region UNION ALL SELECT * FROM (VALUES "
    + ", ".join(f"('{g}', '{m}')" for g, members in GROUPS.items() for m in members)
    + ") AS v(code, member)"
)


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with scenario, nation key and year of their order; value in cents, weight in units.

    Values are whole numbers, so that their sums are exact in any order.
    """
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey"))
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("scenario"), F.year("o_orderdate").alias("year")
    )
    placed = orders.join(customers, "o_custkey", "inner").drop("o_custkey")
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("partkey"), F.col("l_linestatus").alias("linestatus"),
        F.col("l_returnflag").alias("returnflag"), F.rint(F.col("l_extendedprice") * 100).alias("value"),
        F.col("l_quantity").alias("weight"), F.col("l_linenumber").alias("linenumber"),
    )
    return lines.join(placed.hint("merge"), "o_orderkey", "inner").drop("o_orderkey")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nationkey, region0, region."""
    regions = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    named = strict_lookup(read(spark, sf_dir, "nation"), regions, "n_regionkey", ["region"], what="region")
    return named.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("region0"), "region")


def named(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native region and region for a nation key."""
    return strict_lookup(df, nations(spark, sf_dir), "nationkey", ["region0", "region"], what="nation").drop("nationkey")


def summed(
    spark: SparkSession, sf_dir: str, *dims: Column | str, by_region: str | None = "region", **measures: Column
) -> DataFrame:
    """Line facts summed by scenario, dims and year first, then labelled with the region and summed to it.

    ``by_region`` is ``region``, ``region0`` or None; measures default to value and weight.
    """
    measures = measures or {"value": F.col("value"), "weight": F.col("weight")}
    sums = [F.sum(c).alias(n) for n, c in measures.items()]
    facts = line_facts(spark, sf_dir)
    place = [] if by_region is None else ["nationkey"]
    cells = facts.groupBy("scenario", *place, *dims, "year").agg(*sums)
    if by_region is None:
        return cells
    labelled = named(cells, spark, sf_dir)
    if by_region == "region0":
        return labelled
    keys = [c for c in labelled.columns if c not in (*measures, "region0")]
    return labelled.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures])
