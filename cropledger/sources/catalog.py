"""Catalogue of a tree ``root/project/version/scen/query.csv``.

Only paths are listed; the file content is not read. A ``query.csv`` may be a file or a folder of
part files as Spark writes them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.operators.access import optional_filter


def literal_path(path: str) -> str:
    """A path that Spark takes for itself and not for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def without_scheme(path: str) -> str:
    """Path without scheme, as listings and scans spell it differently."""
    return re.sub(r"^[a-z0-9+.-]+:/*", "/", path)


LEVELS = ("version", "scen", "query")


class NotAvailable(LookupError):
    """A requested version, scenario or query is not in the tree, or nothing is left to read."""


def _either(names: Sequence[str] | None, end: str = "") -> str:
    """Glob of one path level: the chosen names, or any."""
    if names is None:
        return f"*{end}"
    inside = [literal_path(n).replace(",", r"\,") for n in names]
    return inside[0] + end if len(inside) == 1 else "{" + ",".join(inside) + "}" + end


def folder_names(spark: SparkSession, pattern: str) -> set[str]:
    """Names of the folders that match a pattern of the store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return {f.getPath().getName() for f in found or [] if f.isDirectory()}


def list_exports(
    spark: SparkSession,
    root: str,
    project: str,
    glob: str = "*.csv",
    *,
    in_versions: Sequence[str] | None = None,
    in_scens: Sequence[str] | None = None,
    in_queries: Sequence[str] | None = None,
) -> DataFrame:
    """path, version, scen, query, length, modified of every file below ``root/project``.

    Folders of versions, scenarios and queries that are not chosen are not listed.
    """
    top = f"{root.rstrip('/')}/{project}"
    wanted = (in_versions, in_scens, in_queries)
    none = "path string, version string, scen string, query string, length long, modified timestamp"
    if any(w is not None and not len(w) for w in wanted):
        return spark.createDataFrame([], none)
    pattern = "/".join([literal_path(top), _either(in_versions), _either(in_scens), _either(in_queries, ".csv")])
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .load(pattern)
            .select("path", "length", F.col("modificationTime").alias("modified"))
        )
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], none)
        raise
    # What follows the listed folder, cut off as text: folders below may be named like the project.
    prefix = f"{without_scheme(top)}/"
    at = F.locate(prefix, F.col("path"))
    message = F.concat(F.lit(f"listed path is not below {top}: "), F.col("path"))
    below = F.substr("path", F.when(at > 0, at).otherwise(F.raise_error(message)) + F.lit(len(prefix)))
    parts = F.split(below, "/")
    query = F.regexp_replace(F.get(parts, F.lit(2)), r"\.csv$", "")
    return files.select(
        "path", F.get(parts, F.lit(0)).alias("version"), F.get(parts, F.lit(1)).alias("scen"), query.alias("query"),
        "length", "modified",
    )


def level_names(spark: SparkSession, root: str, project: str, in_versions: Sequence[str] | None = None) -> dict[str, set[str]]:
    """The versions of a project, and the scenarios of the chosen ones, from two levels of folders."""
    top = literal_path(f"{root.rstrip('/')}/{project}")
    return {"version": folder_names(spark, f"{top}/*"), "scen": folder_names(spark, f"{top}/{_either(in_versions)}/*")}


def find_exports(
    spark: SparkSession,
    root: str,
    project: str,
    *,
    in_versions: Sequence[str] | None = None,
    in_scens: Sequence[str] | None = None,
    in_queries: Sequence[str] | None = None,
) -> DataFrame:
    """The chosen files, found level by level: only folders on the way to them are listed.

    Fails like ``select_exports`` on an unknown name or an empty selection.
    """
    known = level_names(spark, root, project, in_versions) if in_versions or in_scens else {}
    for level, wanted in (("version", in_versions), ("scen", in_scens)):
        unknown = sorted(set(wanted) - known[level]) if wanted else []
        if unknown:
            raise NotAvailable(f"{level} not available: {unknown}")
    listed = list_exports(spark, root, project, in_versions=in_versions, in_scens=in_scens, in_queries=in_queries)
    if in_queries:
        # A query that is in none of the chosen scenarios is unknown, as in select_exports.
        unknown = sorted(set(in_queries) - {r[0] for r in listed.select("query").distinct().collect()})
        if unknown:
            raise NotAvailable(f"query not available: {unknown}")
    if listed.isEmpty():
        raise NotAvailable("no export matches the selection")
    return listed


def versions(catalog: DataFrame) -> DataFrame:
    return catalog.select("version").distinct()


def scenarios(catalog: DataFrame, in_versions: Sequence[str] | None = None) -> DataFrame:
    return optional_filter(catalog, "version", in_versions).select("scen").distinct()


def queries(
    catalog: DataFrame, in_versions: Sequence[str] | None = None, in_scens: Sequence[str] | None = None
) -> DataFrame:
    return optional_filter(optional_filter(catalog, "version", in_versions), "scen", in_scens).select("query").distinct()


def select_exports(
    catalog: DataFrame,
    *,
    in_versions: Sequence[str] | None = None,
    in_scens: Sequence[str] | None = None,
    in_queries: Sequence[str] | None = None,
) -> DataFrame:
    """Selected files; None means all. An unknown name or an empty selection raises ``NotAvailable``."""
    wanted = {"version": in_versions, "scen": in_scens, "query": in_queries}
    available = {
        "version": versions(catalog),
        "scen": scenarios(catalog, in_versions),
        "query": queries(catalog, in_versions, in_scens),
    }
    for level in LEVELS:
        if wanted[level] is None:
            continue
        found = {r[0] for r in optional_filter(available[level], level, wanted[level]).collect()}
        unknown = sorted(set(wanted[level]) - found)
        if unknown:
            raise NotAvailable(f"{level} not available: {unknown}")
    selected = catalog
    for level in LEVELS:
        selected = optional_filter(selected, level, wanted[level])
    if selected.isEmpty():
        raise NotAvailable("no export matches the selection")
    return selected
