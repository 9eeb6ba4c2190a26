"""Exact duplicates by skew-safe combining: locally, then by salted digest, then globally.

Two texts are equal when they are identical after every run of white space (space, tab to carriage return) became one
space. Each of the three steps groups by full content, never by the digest alone. The content travels compressed by one
fixed, lossless setting: equal bytes mean equal texts and the other way round.

A text held by a third of all rows leaves an Arrow batch as one row, meets itself again only within a salt, and the last
step sees one row per salt. What links a document to the row that stays are three small pointers, joined back by key.

Defined results: a null text is an empty text; rows that repeat a doc_id are rows of their own, of which at most one per
text is kept; a null doc_id ranks behind all others, so it is kept only if no equal text has an id. An empty table gives
an empty table. Columns other than the two named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropledger.session import WorkFolder

SALTS = 16
LEVEL = 3

LOCAL = (
    "row_key long, doc_id long, digest binary, local_key long, local_doc long, local_rows long, content binary"
)


def normalised(text: Column) -> Column:
    """Each run of white space as one space; the pattern skips runs that are one space already."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(normalised(text), 256)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group an Arrow batch by full text; the first row of each group carries the content."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column("row_key").to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id")
        missing = np.asarray(ids.is_null())
        numbers = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        group = pc.dictionary_encode(batch.column("text")).indices.to_numpy(zero_copy_only=False)
        order = np.lexsort((keys, numbers, missing, group))
        first = np.flatnonzero(np.diff(group[order], prepend=-1))
        winner = np.empty(n, np.int64)
        rows = np.diff(first, append=n)
        winner[order] = np.repeat(order[first], rows)
        size = np.empty(n, np.int64)
        size[order] = np.repeat(rows, rows)
        texts = batch.column("text")
        content = [pack(texts[i].as_buffer()) if winner[i] == i else None for i in range(n)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_key"), ids, batch.column("digest"), pa.array(keys[winner]), ids.take(pa.array(winner)),
                pa.array(size), pa.array(content, pa.binary()),
            ],
            names=["row_key", "doc_id", "digest", "local_key", "local_doc", "local_rows", "content"],
        )


def _best(key: str) -> Column:
    """Smallest doc_id, null last, then smallest key."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(key).alias("row_key")))


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``salts`` bounds how often one text reaches the last step.
    """
    work = WorkFolder(docs.sparkSession)
    clean = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(F.col(text)).alias("text"))
    keyed = clean.select(
        F.monotonically_increasing_id().alias("row_key"), "doc_id", "text",
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    local = work.keep("local", keyed.mapInArrow(_local, LOCAL))

    # A digest that only one batch knows needs no further step.
    winners = local.where("row_key = local_key").select("row_key", "doc_id", "digest", "local_rows", "content")
    shared = winners.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    # Always a merge join: whether few or many digests are shared, the same bytes move for each row.
    shared = work.keep("shared", shared).hint("merge")
    salted = Window.partitionBy("digest", "salt", "content")
    merged = (
        winners.join(shared, "digest", "left_semi")
        .withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(salts)))
        .select(
            "row_key", "digest", "content", _best("row_key").over(salted).alias("best"),
            F.sum("local_rows").over(salted).alias("rows"),
        )
    )
    merged = work.keep(
        "salted",
        merged.select(
            "row_key", "digest", F.col("best.doc_id").alias("doc_id"), F.col("best.row_key").alias("salt_key"), "rows",
            F.when(F.col("row_key") == F.col("best.row_key"), F.col("content")).alias("content"),
        ),
    )
    whole = Window.partitionBy("digest", "content")
    combined = (
        merged.where("row_key = salt_key")
        .select("salt_key", _best("salt_key").over(whole).alias("best"), F.sum("rows").over(whole).alias("group_size"))
        .select(
            "salt_key", F.col("best.doc_id").alias("keep_id"), F.col("best.row_key").alias("keep_key"), "group_size"
        )
    )
    combined = work.keep("combined", combined)
    found = work.keep(
        "found",
        merged.select(F.col("row_key").alias("local_key"), "salt_key").join(combined, "salt_key").drop("salt_key"),
    )
    alone = F.col("keep_key").isNull()
    return local.drop("content").join(found, "local_key", "left").select(
        "doc_id",
        F.when(alone, F.col("local_doc")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", "local_rows").alias("group_size"),
        (F.col("row_key") == F.coalesce("keep_key", "local_key")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that share doc_id and text one stays."""
    mark = "__copy_key"

    def name(text_digest: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text_digest)

    kept = classes(docs).where("kept").select(name(F.col("text_sha256")).alias(mark))
    rows = docs.withColumn(mark, name(digest(F.col("text"))))
    return rows.join(kept, mark, "left_semi").dropDuplicates([mark]).drop(mark)
