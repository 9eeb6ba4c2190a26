"""Session settings the plans are written for."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster, submit with SETTINGS instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cropledger")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A local session that names none gets a folder of its own, removed when Python ends. On any other master a
    missing setting is an error: executors would write to their own disks and read back nothing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="cropledger-")
            atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
        folder = _LOCAL[app]
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, root: str | None = None) -> str:
    """A path of its own below ``root``, by default the shared folder."""
    return f"{(root or shared_folder(spark)).rstrip('/')}/cropledger-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store holds it."""
    store, target = _located(spark, path)
    store.delete(target, True)


def file_listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of change of the files at a path: differs once the input was written anew."""
    store, target = _located(spark, path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in store.listStatus(target)))


def folder_children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    store, target = _located(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(target)) if store.exists(target) else []


def join_files(spark: SparkSession, head: str, paths: list[str], target: str) -> None:
    """One file of a head line and files in order: joined by the store if it can, else copied byte by byte."""
    store, to = _located(spark, target)
    out = store.create(to, True)
    try:
        out.write(bytearray(head.encode()))
        if not paths or store.getScheme() != "hdfs":
            conf = spark._jsc.hadoopConfiguration()
            for path in paths:
                part = store.open(_located(spark, path)[1])
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
            return
    finally:
        out.close()
    sources = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(paths))
    for k, path in enumerate(paths):
        sources[k] = _located(spark, path)[1]
    store.concat(to, sources)


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, target = _located(spark, path)
    return store.exists(target)


def write_and_read_back(df: DataFrame, path: str, *, count: bool = True) -> DataFrame:
    """Cut the lineage with a written table, so that a lost executor costs a re-read, not a re-run.

    Fails if the table holds other than the rows written, as it would on a folder that is not shared; without ``count``
    this is not looked at, for a folder that has been before.
    """
    if not count:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    found = back.count()
    if found != written.get["rows"]:
        raise RuntimeError(f"{written.get['rows']} rows written to {path}, {found} read back")
    return back


class WorkFolder:
    """Written intermediates of one run, by name, in a folder of its own below the shared one or another given."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = fresh_folder(spark, root)

    def keep(self, name: str, df: DataFrame, *, count: bool = True) -> DataFrame:
        """Write a table and read it back."""
        return write_and_read_back(df, f"{self.path}/{name}", count=count)

    def drop(self, *names: str) -> None:
        """Delete tables nothing reads any more; without names, the whole folder."""
        for path in [f"{self.path}/{n}" for n in names] or [self.path]:
            remove_folder(self.spark, path)
