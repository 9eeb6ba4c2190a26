"""Secrets through an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger has one row for each blob and each version
of a rule that has been run on it, with what was found, so a later scan reads only pairs the ledger lacks: new blobs under
all rules, old blobs under new rule versions. Findings are joined back to every path that holds the blob, now or earlier.

A scan thins out copies inside each Arrow batch before any text moves, and texts move compressed. One append is one
committed write: a scan that fails leaves no rows, and is simply run again.

Defined results: a null text is an empty blob. Rows that repeat a path are paths of their own; a null path stays. An empty
table gives an empty table and leaves an empty entry in the ledger.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.session import WorkFolder, folder_exists, fresh_folder

LEVEL = 3


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first and without overlap, whose ``group`` has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    flags: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.compile(self.pattern, self.flags).finditer(text)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


BASE = [
    Rule(
        "assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8, 2, re.IGNORECASE | re.ASCII,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16),
    # The longest run of hex digits is the same match whether its least length is asked for here or afterwards.
    Rule("hex", 1, r"[0-9a-f]{32,}", 32),
]
MORE = [
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", 1, r"\bgh[opsru]_[A-Za-z0-9]{36,}", 0, 0, re.ASCII),
    # From the start of a run only: each run is read once, however many starts it holds.
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, re.ASCII),
]
RULES = [*BASE, *MORE]
LEDGER = "blob binary, kind string, version int, spans array<struct<start:long,end:long>>"


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each blob of an Arrow batch once, compressed."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        codes = pc.dictionary_encode(batch.column("blob")).indices.to_numpy(zero_copy_only=False)
        once = np.sort(np.unique(codes, return_index=True)[1])
        texts = batch.column("text")
        packed = [pack(texts[int(i)].as_buffer()) for i in once]
        yield pa.RecordBatch.from_arrays([batch.column("blob").take(pa.array(once)), pa.array(packed, pa.binary())], names=["blob", "content"])


def _scan(rules: list[Rule]):
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            blobs, marks, versions, spans = [], [], [], []
            done = batch.column("done").to_pylist()
            for blob, content, seen in zip(batch.column("blob"), batch.column("content"), done, strict=True):
                text = unpack(content.as_buffer()).decode("utf-8")
                for rule in rules:
                    if f"{rule.kind}:{rule.version}" not in seen:
                        blobs.append(blob)
                        marks.append(rule.kind)
                        versions.append(rule.version)
                        spans.append([{"start": a, "end": b} for a, b in rule.spans(text)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b.as_py() for b in blobs], pa.binary()), pa.array(marks, pa.string()),
                    pa.array(versions, pa.int32()), pa.array(spans, kinds),
                ],
                names=["blob", "kind", "version", "spans"],
            )

    return run


class Ledger:
    """Rows (blob, kind, version, spans) of all scans so far, below one folder on shared storage."""

    def __init__(self, spark: SparkSession, folder: str, rules: list[Rule] = RULES):
        self.spark, self.folder, self.rules = spark, folder.rstrip("/"), rules

    def rows(self) -> DataFrame:
        if not folder_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.folder)

    def scan(self, paths: DataFrame) -> None:
        """Run the rules on blobs of ``paths`` (path, blob, text) that the ledger lacks them for."""
        current = [f"{r.kind}:{r.version}" for r in self.rules]
        blobs = paths.select("blob", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_blobs, "blob binary, content binary")
        pair = F.concat_ws(":", "kind", F.col("version").cast("string"))
        done = self.rows().select("blob", pair.alias("pair")).where(F.col("pair").isin(current))
        done = done.groupBy("blob").agg(F.collect_set("pair").alias("done"))
        none = F.array().cast("array<string>")
        todo = blobs.join(done, "blob", "left").withColumn("done", F.coalesce("done", none))
        todo = todo.where(F.size("done") < len(current)).dropDuplicates(["blob"])
        todo.mapInArrow(_scan(self.rules), LEDGER).write.mode("append").parquet(self.folder)

    def findings(self) -> DataFrame:
        """By blob with findings under the current rules: counts by kind, base_spans and spans as text."""
        base = [r.kind for r in BASE]
        order = {r.kind: k for k, r in enumerate(self.rules)}
        rank = F.create_map(*[x for kind, k in order.items() for x in (F.lit(kind), F.lit(k))])
        current = F.concat_ws(":", "kind", F.col("version").cast("string")).isin([f"{r.kind}:{r.version}" for r in self.rules])
        rows = self.rows().where(current & (F.size("spans") > 0)).dropDuplicates(["blob", "kind"])
        spans = F.transform(
            "spans", lambda s: F.struct(s["start"].alias("start"), rank[F.col("kind")].alias("rank"), s["end"].alias("end"), F.col("kind").alias("kind"))
        )
        every = rows.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("all"))

        def text(items):
            return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

        def number(kind: str):
            return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

        return every.select(
            "blob", *map(number, order), text(F.filter("all", lambda s: s["kind"].isin(base))).alias("base_spans"),
            text(F.col("all")).alias("spans"),
        )


def addressed(docs: DataFrame, path: str, text: str) -> DataFrame:
    """path, blob, text: the blob is the SHA-256 of the text in UTF-8."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(path).alias("path"), F.unhex(F.sha2(whole, 256)).alias("blob"), whole.alias("text"))


def scan(docs: DataFrame, *, path: str = "doc_id", text: str = "text", ledger: Ledger | None = None) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return one row per row of ``docs``: path, counts, spans."""
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, f"{fresh_folder(spark)}/ledger")
    paths = addressed(docs, path, text)
    ledger.scan(paths)
    found = WorkFolder(spark).keep("found", ledger.findings())
    joined = paths.drop("text").join(found, "blob", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in found.columns if c.startswith("n_")]
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")]
    return joined.select("path", *numbers, *texts)
