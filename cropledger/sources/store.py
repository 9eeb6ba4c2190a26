"""Named tables on shared storage, and the ledger of the exports loaded into them.

A plain table is a Parquet folder, partitioned if asked for. Exports lie together, partitioned by query, load, version and
scenario. The ledger is one row per export file, with its length and time and the load that read it. A load reads only
exports whose files are not in the ledger as they are, writes their rows in one job, and then publishes the next ledger: the
``_SUCCESS`` mark that Spark leaves at the end of that write is the one step that makes a load visible. A load that fails leaves
nothing that anybody reads. Rows of replaced and vanished exports go after the ledger no longer names them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.operators.access import optional_filter
from cropledger.session import WorkFolder, folder_children, remove_folder
from cropledger.sources import catalog as cat
from cropledger.sources.catalog import without_scheme
from cropledger.sources.exports import Parsed, parse, stored_name

EXPORTS, LEDGERS = "exports", "load_ledger"
UNIT = ["query", "version", "scen"]
LEDGER = (
    "query string, version string, scen string, path string, length long, modified timestamp, load string, columns array<string>, reason string"
)
#: What a load left out, by name, with the columns of the tables.
LEFT_OUT = {
    "rejected_files": "query string, path string, reason string",
    "rejected_rows": "query string, path string, text string, reason string",
    "rejected_cells": "query string, path string, year int, text string",
}
_KIND = {"rejected_rows": "lines", "rejected_cells": "cells"}
_OWN = {"__text": "text", "__path": "path", "__reason": "reason"}


class Store:
    """Tables by name below one folder; a set of tables grows by saving more of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Write a table; partitions it brings replace theirs, other partitions stay."""
        if not isinstance(df, DataFrame):
            raise TypeError(f"{name} is not a table")
        if name in (EXPORTS, LEDGERS, *LEFT_OUT):
            raise ValueError(f"{name} is kept for loaded exports")
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(name))

    def load(self, name: str, *, versions: Sequence[str] | None = None, scens: Sequence[str] | None = None) -> DataFrame:
        """Read a table, pruned to the chosen partitions; a table that was never saved is an error.

        Exports are read as the last published load left them. ``rejected_files``, ``rejected_rows`` and ``rejected_cells`` hold
        what the last load left out of the files it read; ``left_out`` has that of all files.
        """
        if name in LEFT_OUT:
            return self.left_out(name, last_only=True)
        df = self._export(name)
        if df is None:
            try:
                df = self.spark.read.parquet(self.path(name))
            except AnalysisException as e:
                if e.getCondition() == "PATH_NOT_FOUND":
                    raise FileNotFoundError(f"no stored table {name} in {self.folder}") from e
                raise
        return optional_filter(optional_filter(df, "version", versions), "scen", scens)

    # -- exports ---------------------------------------------------------------------------------------

    def last_load(self) -> int:
        """Number of the last published load, 0 before the first."""
        done = [n for n in folder_children(self.spark, self.path(LEDGERS)) if "_SUCCESS" in folder_children(self.spark, self.path(f"{LEDGERS}/{n}"))]
        return max((int(n) for n in done), default=0)

    def ledger(self) -> DataFrame:
        """The export files that the tables are made of."""
        last = self.last_load()
        if not last:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path(f"{LEDGERS}/{last:08d}"))

    def _rows(self, kind: str, columns: str) -> DataFrame:
        """Rows of one kind of all loads, with their partitions; none before the first."""
        schema = f"{columns}, query string, load string, version string, scen string"
        path = f"{self.path(EXPORTS)}/kind={kind}"
        if not folder_children(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _export(self, name: str) -> DataFrame | None:
        """Rows of an export, of the load that the ledger names for each version and scenario."""
        own = self.ledger().where((F.col("query") == name) & F.col("reason").isNull())
        units = own.groupBy("load", "version").agg(F.collect_set("scen").alias("scens"), F.flatten(F.collect_set("columns")).alias("columns")).collect()
        if not units:
            return None
        dims = list(dict.fromkeys(c for u in sorted(units, key=lambda u: (u["load"], u["version"])) for c in u["columns"]))
        schema = ", ".join([*[f"`{stored_name(c)}` string" for c in dims], "year int", "value double"])
        # Partitions are chosen by value, so that others are not read; the number of them does not grow with the rows.
        chosen: list[Column] = [(F.col("load") == u["load"]) & (F.col("version") == u["version"]) & F.col("scen").isin(u["scens"]) for u in units]
        rows = self._rows("rows", schema).where((F.col("query") == name) & reduce(lambda a, b: a | b, chosen))
        named = [F.col(f"`{stored_name(c)}`").alias(c) for c in dims]
        return rows.select(*named, "year", "value", F.col("scen").alias("ss"), "version", "scen")

    def left_out(self, name: str, *, last_only: bool = False) -> DataFrame:
        """Files, rows or cells left out of the exports as they are now, or of those that the last load read."""
        columns = [c.split(" ")[0] for c in LEFT_OUT[name].split(", ")]
        ledger = self.ledger()
        if last_only:
            ledger = ledger.where(F.col("load").startswith(_label(self.last_load())))
        if name == "rejected_files":
            return ledger.where(F.col("reason").isNotNull()).select(*columns)
        kinds = {"path": "string", "text": "string", "reason": "string", "year": "int"}
        named = {v: k for k, v in _OWN.items()}
        stored = ", ".join(f"{named.get(c, c)} {kinds[c]}" for c in columns if c != "query")
        rows = self._rows(_KIND[name], stored)
        current = ledger.select(*UNIT, "load").distinct()
        return rows.join(current, [*UNIT, "load"], "left_semi").select(*[F.col(named.get(c, c)).alias(c) for c in columns])

    def publish(self, ledger: DataFrame) -> None:
        """Make the next ledger the one that counts; fails if another load came first."""
        number = self.last_load() + 1
        ledger.select(*[c.split(" ")[0] for c in LEDGER.split(", ")]).coalesce(1).write.mode("error").parquet(self.path(f"{LEDGERS}/{number:08d}"))

    def remove_unnamed(self, gone: set[tuple[str, str, str, str]]) -> None:
        """Delete the partitions (query, load, version, scen) that the ledger no longer names, what failed loads left, and older ledgers."""
        top = self.path(EXPORTS)

        def walk(path: str, left: set[tuple[str, ...]]) -> None:
            for child in folder_children(self.spark, path):
                name = unquote(child.partition("=")[2])
                below = {x[1:] for x in left if x[0] == name}
                if () in below:
                    remove_folder(self.spark, f"{path}/{child}")
                elif below:
                    walk(f"{path}/{child}", below)

        last = self.last_load()
        named = {tuple(r) for r in self.ledger().select("query", "load").distinct().collect()}
        for kind in folder_children(self.spark, top):
            walk(f"{top}/{kind}", gone)
            for query in folder_children(self.spark, f"{top}/{kind}"):
                for load in folder_children(self.spark, f"{top}/{kind}/{query}"):
                    label = load.partition("=")[2]
                    if (unquote(query.partition("=")[2]), label) not in named and label[: len(_label(last))] <= _label(last):
                        remove_folder(self.spark, f"{top}/{kind}/{query}/{load}")
        for name in folder_children(self.spark, self.path(LEDGERS)):
            if int(name) < last - 1:
                remove_folder(self.spark, self.path(f"{LEDGERS}/{name}"))


def _label(number: int) -> str:
    """What the names of the loads of a number begin with; a load that failed had another end."""
    return f"load{number:08d}"


def load_exports(
    spark: SparkSession,
    root: str,
    project: str,
    store: Store,
    *,
    versions: Sequence[str] | None = None,
    scens: Sequence[str] | None = None,
    queries: Sequence[str] | None = None,
) -> list[str]:
    """Bring the chosen exports of the store up to date with the tree; returns the names of the queries that were read.

    Exports whose files are as the ledger has them are not read. All others are read and written in one job, whatever the
    number of queries. Exports that are gone from the chosen part of the tree go from the store too.
    """
    listed = cat.find_exports(spark, root, project, in_versions=versions, in_scens=scens, in_queries=queries)
    ledger = store.ledger()
    known = optional_filter(optional_filter(optional_filter(ledger, "version", versions), "scen", scens), "query", queries)
    # A file by where it lies and what it is; files of another tree with the same names are other files.
    file = [*UNIT, "path", "length", "modified"]
    work = WorkFolder(spark)
    try:
        listed = work.keep("listed", listed.select(*file))
        changed = listed.select(*file).exceptAll(known.select(*file)).unionByName(known.select(*file).exceptAll(listed.select(*file)))
        changed = work.keep("changed", changed.select(*UNIT).distinct())
        to_read = listed.join(changed, UNIT, "left_semi").collect()
        load = f"{_label(store.last_load() + 1)}-{uuid.uuid4().hex[:8]}"
        columns: dict[str, list[str]] = {}
        reasons: dict[str, str] = {}
        if to_read:
            paths = sorted(r["path"] for r in to_read)
            parsed = parse(spark, paths, {without_scheme(r["path"]): r["query"] for r in to_read}, work.keep)
            if parsed.names:
                _write(store, parsed, load)
            columns, reasons = parsed.names, dict(parsed.rejected_files)
            reasons |= {r["path"]: "no readable export" for r in to_read if r["query"] not in columns}
        new = spark.createDataFrame(
            [(*[r[c] for c in file], load, columns.get(r["query"], []), reasons.get(r["path"])) for r in to_read], LEDGER
        )
        gone = known.join(changed, UNIT, "left_semi").select("query", "load", "version", "scen").distinct()
        gone = {tuple(r) for r in gone.collect()}
        store.publish(ledger.join(changed, UNIT, "left_anti").unionByName(new))
        if gone or to_read:
            store.remove_unnamed(gone)
    finally:
        work.drop()
    return sorted(columns)


def _write(store: Store, parsed: Parsed, load: str) -> None:
    """Rows, cells and lines of a load in one job, each in its partitions."""
    rows = parsed.out.withColumn("load", F.lit(load))
    rows.write.mode("append").partitionBy("kind", "query", "load", "version", "scen").parquet(store.path(EXPORTS))
    parsed.check()
