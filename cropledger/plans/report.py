"""The report: contract, assembly, checks, export."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.operators.lookup import guard
from cropledger.operators.reshape import union_all
from cropledger.plans import balance, emissions, food, labour, land, resources, socio, yields
from cropledger.plans.inputs import REPORT_COLUMNS, ModelInputs
from cropledger.session import folder_children, join_files, remove_folder

EXPORT_COLUMNS = ["Model", "Scenario", "Region", "Item", "Variable", "Year", "Unit", "Value"]
KEY = ["Scenario", "Region", "Item", "Variable", "Year", "Unit"]

# The report tables by name.
TABLES: dict[str, Callable[[ModelInputs], DataFrame]] = {
    "gdp": socio.gdp,
    "population": socio.population,
    "area": land.area,
    "climate_yield_effect": land.climate_yield_effect,
    "land_cover": land.land_cover,
    "crop_yield": yields.crop_yield,
    "quantities": balance.quantities,
    "producer_price": balance.producer_price,
    "calories": food.calories,
    "wage": labour.wage,
    "employment": labour.employment,
    "employment_share": labour.employment_share,
    "carbon_price": emissions.carbon_price,
    "co2": emissions.co2,
    "farm_gases": emissions.farm_gases,
    "water": resources.water,
    "fertiliser": resources.fertiliser,
}


class BrokenContract(ValueError):
    """A report table lacks a column or has one too many."""


def _missing(column: str, df: DataFrame):
    c = F.col(column)
    return c.isNull() | F.isnan(c) if dict(df.dtypes)[column] == "double" else c.isNull()


def check_columns(df: DataFrame) -> DataFrame:
    extra, absent = set(df.columns) - set(REPORT_COLUMNS), set(REPORT_COLUMNS) - set(df.columns)
    if extra or absent:
        raise BrokenContract(f"unexpected columns {sorted(extra)}, absent columns {sorted(absent)}")
    return df.select(*REPORT_COLUMNS)


def missing_values(df: DataFrame) -> DataFrame:
    """Number of missing entries by report column, in one aggregation."""
    df = check_columns(df)
    return df.agg(*[F.count_if(_missing(c, df)).alias(c) for c in REPORT_COLUMNS])


def checked(df: DataFrame) -> DataFrame:
    """The report contract: exactly the report columns (now) and no missing entry (when the rows are read)."""
    df = check_columns(df)
    broken = reduce(lambda a, b: a | b, [_missing(c, df) for c in REPORT_COLUMNS])
    shown = F.to_json(F.struct(*REPORT_COLUMNS), {"ignoreNullFields": "false"})
    return guard(df, broken, F.concat(F.lit("missing entry in report row: "), shown))


def collect_tables(m: ModelInputs, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Checked report tables by name; all of them unless some are named."""
    return {name: checked(TABLES[name](m)) for name in (names or TABLES)}


def assemble(tables: Mapping[str, DataFrame], model: str) -> DataFrame:
    """All tables under one another, with the model label, columns in export order."""
    return union_all(list(tables.values())).withColumn("Model", F.lit(model)).select(*EXPORT_COLUMNS)


def without_shared(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables without rows that arrive with another one too: land cover repeats the energy-crop rows of area.

    Which rows those are is told by table and variable, so that neither the last bit of a sum nor two real rows that
    happen to be equal decide.
    """
    kept = dict(tables)
    if {"area", "land_cover"} <= set(kept):
        kept["land_cover"] = kept["land_cover"].where(F.col("Variable") != "AREA")
    return kept


def rows_without_shared(rows: DataFrame) -> DataFrame:
    """``without_shared`` on all tables of a report under one another, whose rows bear the ``name`` of their table: one scan."""
    return rows.where((F.col("name") != "land_cover") | (F.col("Variable") != "AREA"))


def repeated_keys(report: DataFrame) -> DataFrame:
    """Report keys that occur more than once."""
    return report.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def coverage(report: DataFrame) -> DataFrame:
    """Rows and span by scenario and variable."""
    return report.groupBy("Scenario", "Variable").agg(
        F.count(F.lit(1)).alias("n"), F.min("Year").alias("first_year"), F.max("Year").alias("last_year")
    )


def negative_values(report: DataFrame, variable: str) -> DataFrame:
    return report.where((F.col("Variable") == variable) & (F.col("Value") < 0))


def distinct_variables(report: DataFrame) -> DataFrame:
    return report.select("Variable").distinct()


def spot(report: DataFrame, scenario: str, year: int) -> DataFrame:
    return report.where((F.col("Scenario") == scenario) & (F.col("Year") == year))


def table_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and row count of every table."""
    return union_all([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n, df in tables.items()])


def probes(rows: DataFrame) -> DataFrame:
    """Every check of a whole report, whose rows bear the ``name`` of their table, in one scan and one aggregation.

    ``probe`` tells what a row is about: a repeated ``key``, the ``coverage`` of a scenario and variable, a ``table``, or the
    ``report``. Each has its rows, years, negative values (to six digits) and missing entries, in all and by column.
    """
    by = ["name", *KEY]
    sets = [KEY, ["Scenario", "Variable"], ["name"], []]
    missing = [F.count_if(_missing(c, rows)) for c in REPORT_COLUMNS]
    probe = (
        F.when(F.grouping("Region") == 0, "key").when(F.grouping("Scenario") == 0, "coverage")
        .when(F.grouping("name") == 0, "table").otherwise("report")
    )
    found = rows.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(
        probe.alias("probe"), F.count(F.lit(1)).alias("n"), F.min(F.col("Year")).alias("first_year"), F.max(F.col("Year")).alias("last_year"),
        F.count_if(F.round("Value", 6) < 0).alias("negative"), reduce(lambda a, b: a + b, missing).alias("missing"),
        *[m.alias(f"missing_{c}") for c, m in zip(REPORT_COLUMNS, missing)],
    )
    return found.where((F.col("probe") != "key") | (F.col("n") > 1))


def write_report(report: DataFrame, path: str, *, single_file: bool = False) -> None:
    """CSV with a header, columns in export order; part files unless one sorted file is asked for.

    For one file the rows are sorted by range over many tasks, written as parts without header, and the parts joined in order
    behind the header: by the store itself where it can join files, else by copying bytes. Equal rows give equal bytes.
    """
    rows = report.select(*EXPORT_COLUMNS)
    if not single_file:
        rows.write.mode("overwrite").option("header", "true").csv(path)
        return
    spark = report.sparkSession
    parts = f"{path.rstrip('/')}.parts"
    order = ["Model", *KEY, "Value"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").csv(parts)
    try:
        names = [n for n in folder_children(spark, parts) if n.startswith("part-")]
        remove_folder(spark, path)
        join_files(spark, ",".join(EXPORT_COLUMNS) + "\n", [f"{parts}/{n}" for n in names], f"{path}/part-00000.csv")
    finally:
        remove_folder(spark, parts)
