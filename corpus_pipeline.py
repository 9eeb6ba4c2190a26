"""From raw documents to packed training sequences, one written table per stage.

A stage takes the rows its predecessor left, with all their columns, and all but the last return rows of the same columns. An empty
table stays empty through all of them. A null text is an empty one. Columns other than doc_id and text are carried along and never
looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cropledger.llm import dart_minhash, decontaminate, exact_dedup, importance, packing
from cropledger.session import WorkFolder

#: Rows of an Arrow batch. A batch of documents is held by Spark and by Python, on the way in and on the way out.
BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key, "10000"))
    spark.conf.set(key, str(rows if 0 < rows < BATCH_ROWS else BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose importance weight the classifier rejects go.

    The weight is that of the resampling, and what it rejects goes; there is no draw, as a draw would throw away clean documents too.
    A row is judged by its text alone: repeated rows stay or go together, null ids are judged like others, but teach nothing.
    Without labels of both kinds nothing goes.
    """
    _small_batches(spark)
    return importance.keep_accepted(docs, importance.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays.

    A null doc_id ranks behind all others. Of rows equal in doc_id and text one stays, whichever, if other columns differ.
    """
    _small_batches(spark)
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest doc_id stays.

    A null doc_id ranks behind all others. Rows of different texts that share the smallest doc_id of a group all stay.
    """
    _small_batches(spark)
    return dart_minhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Every row is judged by its whole text, repeated rows and null ids alike. With an empty benchmark nothing goes.
    """
    _small_batches(spark)
    return decontaminate.keep_clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences: one row per piece.

    Rows are documents of their own, repeated or null ids too; an empty text is its end id alone.
    """
    _small_batches(spark)
    return packing.pack(docs)


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("decontamination", clean), ("packing", packed)]

#: The stages train models, hash weighted shingles and tokenise, which SQL cannot express; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    work = WorkFolder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.keep(f"stage{k}", stage(spark, docs, sf_dir))
    return docs
