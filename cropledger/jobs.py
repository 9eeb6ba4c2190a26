"""The batch jobs: list and load raw exports, add auxiliary tables, write the report or tables behind figures.

    spark-submit cropledger/jobs.py list ROOT PROJECT [--version V ...] [--scen S ...]
    spark-submit cropledger/jobs.py load ROOT PROJECT STORE [--version V ...] [--scen S ...] [--query Q ...]
    spark-submit cropledger/jobs.py auxiliary STORE NAME PATH [--column ours=theirs ...]
    spark-submit cropledger/jobs.py report STORE VERSION OUT --scenarios FILE --price-levels FILE --model LABEL [--mapping NAME=FILE ...]
    spark-submit cropledger/jobs.py figures STORE VERSION OUT --scenarios FILE --price-levels FILE [--figure NAME ...]

--work names the shared folder for intermediates; by default it is the cluster's spark.checkpoint.dir. The folder of a
run is removed when the job ends. A mapping is a table in Parquet, or CSV with a header, with our column names.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.functions.units import price_levels
from cropledger.plans import figures, report
from cropledger.plans.inputs import AUXILIARY, stored_inputs
from cropledger.session import WorkFolder
from cropledger.sources import catalog as cat
from cropledger.sources.dims import Dimensions, default_dimensions, read_auxiliary
from cropledger.sources.literal import literal_table
from cropledger.sources.store import Store, load_exports


class RepeatedRows(ValueError):
    """The assembled report has a key more than once."""


#: Tables behind figures by name, for the figures job.
FIGURES = {
    name: getattr(figures, name)
    for name in (
        "area_snapshot", "land_snapshot", "yield_snapshot", "supply_use_grid", "price_index", "average_price", "prices_by_item",
        "calories_2050", "wage_index", "employment_share_shown", "carbon_price_from_2025", "annual_co2", "cumulative_co2",
        "cumulative_land_use_co2", "cumulative_farm_gases", "cumulative_water", "cumulative_fertiliser",
    )
}


def listing(
    spark: SparkSession, root: str, project: str, versions: Sequence[str] | None = None, scens: Sequence[str] | None = None
) -> DataFrame:
    """What a tree holds: level (version, scen, query) and name, sorted. Files are listed below the chosen folders only."""
    names = cat.level_names(spark, root, project, versions)
    folders = literal_table(spark, {"level": "string", "name": "string"}, [(level, n) for level in names for n in names[level]])
    found = cat.list_exports(spark, root, project, in_versions=versions, in_scens=scens)
    every = folders.unionByName(found.select(F.lit("query").alias("level"), F.col("query").alias("name")).distinct())
    return every.orderBy(F.array_position(F.array(*map(F.lit, cat.LEVELS)), F.col("level")), "name")


def load(
    spark: SparkSession, root: str, project: str, store: Store, versions: Sequence[str] | None = None,
    scens: Sequence[str] | None = None, queries: Sequence[str] | None = None,
) -> list[str]:
    """The chosen queries of the chosen versions and scenarios into the store; all unless some are named."""
    return load_exports(spark, root, project, store, versions=versions, scens=scens, queries=queries)


def own_dimensions(spark: SparkSession, files: dict[str, str]) -> Dimensions:
    """The built-in dimensions with some of them read from files instead."""
    default = default_dimensions(spark)
    schemas = {name: getattr(default, name).schema.simpleString()[len("struct<"):-1].replace(":", " ") for name in files}
    return default.with_tables(**{name: read_auxiliary(spark, path, schemas[name]) for name, path in files.items()})


def add_auxiliary(store: Store, name: str, path: str, columns: dict[str, str] | None = None) -> None:
    """An auxiliary table into the store, under our column names."""
    store.save(name, read_auxiliary(store.spark, path, AUXILIARY[name], columns))


def scenario_list(spark: SparkSession, path: str, column: str = "Scenario") -> list[str]:
    """Scenario labels of the reporting sets, blanks left out, in file order of first mention."""
    labels = spark.read.option("header", "true").csv(path).select(F.trim(F.col(column)).alias("s"))
    found = labels.where(F.col("s") != "").withColumn("at", F.monotonically_increasing_id())
    return [r["s"] for r in found.groupBy("s").agg(F.min("at").alias("at")).orderBy("at").collect()]


def build_report(
    store: Store,
    version: str,
    scenarios: Sequence[str],
    levels: dict[int, float],
    model: str,
    *,
    dims: Dimensions | None = None,
    names: Sequence[str] | None = None,
    work: WorkFolder | None = None,
) -> DataFrame:
    """The whole report, checked: written to the work folder, so that a repeated key fails before anything is exported."""
    work = work or WorkFolder(store.spark)
    m = stored_inputs(store, version, scenarios, levels, dims, work=work)
    whole = work.keep("report", report.assemble(report.without_shared(report.collect_tables(m, names)), model))
    repeated = report.repeated_keys(whole).first()
    if repeated:
        raise RepeatedRows(str(repeated))
    return whole


def build_figures(
    store: Store, version: str, scenarios: Sequence[str], levels: dict[int, float], names: Sequence[str], work: WorkFolder,
) -> dict[str, DataFrame]:
    """Tables behind figures, by name."""
    m = stored_inputs(store, version, scenarios, levels, work=work)
    return {name: FIGURES[name](m) for name in names}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    for kind, names in {"list": ("root", "project"), "load": ("root", "project", "store")}.items():
        job = jobs.add_parser(kind)
        for name in names:
            job.add_argument(name)
        job.add_argument("--version", action="append")
        job.add_argument("--scen", action="append")
        if kind == "load":
            job.add_argument("--query", action="append")
    job = jobs.add_parser("auxiliary")
    job.add_argument("store")
    job.add_argument("name", choices=sorted(AUXILIARY))
    job.add_argument("path")
    job.add_argument("--column", action="append", default=[])
    job = jobs.add_parser("report")
    for name in ("store", "version", "out"):
        job.add_argument(name)
    for name in ("--scenarios", "--price-levels", "--model"):
        job.add_argument(name, required=True)
    job.add_argument("--single-file", action="store_true")
    job.add_argument("--mapping", action="append", default=[])
    job.add_argument("--work")
    job = jobs.add_parser("figures")
    for name in ("store", "version", "out"):
        job.add_argument(name)
    for name in ("--scenarios", "--price-levels"):
        job.add_argument(name, required=True)
    job.add_argument("--figure", action="append", choices=sorted(FIGURES))
    job.add_argument("--work")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"cropledger {given.job}").getOrCreate()
    if given.job == "list":
        for row in listing(spark, given.root, given.project, given.version, given.scen).collect():
            print(f"{row['level']}\t{row['name']}")
        return
    store = Store(spark, given.store)
    if given.job == "load":
        print("\n".join(load(spark, given.root, given.project, store, given.version, given.scen, given.query)))
        return
    if given.job == "auxiliary":
        add_auxiliary(store, given.name, given.path, dict(c.split("=", 1) for c in given.column))
        return
    scenarios = scenario_list(spark, given.scenarios)
    levels = price_levels(read_auxiliary(spark, given.price_levels, "year int, level double"))
    work = WorkFolder(spark, given.work)
    try:
        if given.job == "figures":
            for name, table in build_figures(store, given.version, scenarios, levels, given.figure or sorted(FIGURES), work).items():
                table.write.mode("overwrite").parquet(f"{given.out}/{name}")
        else:
            dims = own_dimensions(spark, dict(x.split("=", 1) for x in given.mapping)) if given.mapping else None
            whole = build_report(store, given.version, scenarios, levels, given.model, dims=dims, work=work)
            report.write_report(whole, given.out, single_file=given.single_file)
    finally:
        work.drop()


if __name__ == "__main__":
    main()
