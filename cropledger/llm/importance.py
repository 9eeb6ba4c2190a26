"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Two bags of hashed n-grams are counted: the raw one over every document, the target one over labelled good documents. A
document's log weight is the log ratio of both models, averaged over its n-grams and ``PRIOR`` neutral ones and scaled to
``span`` of them, so that length alone makes no document likely. Adding a Gumbel draw to the log weight and taking the k largest sums draws k
documents without replacement by those weights. The draw is a hash of the doc_id and a seed: the same in every run.

An n-gram is a run of letters and digits, a run of other marks, or two neighbours of either kind; case counts.

What is bounded: the two models hold ``BUCKETS`` numbers each and are the only thing that reaches the driver. The target
model and the threshold are fitted on at most ``LABELLED`` labelled rows of each class, drawn by hash of the doc_id. Raw
counts take in all documents, and every document is scored whole.

Defined results: null or empty texts, and texts without a single run, have log weight 0. Rows that repeat a doc_id share
its draw. Without labelled rows of both classes nothing is rejected. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm import text as tx
from cropledger.session import WorkFolder

BUCKETS = 1 << 16
LABELLED = 20_000
SPAN = 64
SMOOTHING = 1.0
#: So many n-grams of no weight join each document: a handful of words says little.
PRIOR = 16
#: Share of labelled good documents that the threshold may cost at most.
LOSS = 0.002
PAIR = np.uint64(0xD6E8FEB86659FD93)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a text column, and the row of each."""
    data, offsets = tx.flat(column)
    start, length = tx.runs(data, offsets, tx.KINDS)
    word, row = tx.hashes(data, start, length), tx.owners(offsets, start)
    both = tx.mix(word[:-1] * PAIR + word[1:])[row[:-1] == row[1:]]
    bucket = np.concatenate([word, both]) & np.uint64(BUCKETS - 1)
    return bucket.astype(np.int64), np.concatenate([row, row[:-1][row[:-1] == row[1:]]])


def _count(good: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in tx.pieces(batch, "text"):
                bucket, row = grams(part.column("text"))
                raw += np.bincount(bucket, minlength=BUCKETS)
                ids = part.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
                target += np.bincount(bucket[np.isin(ids, good)[row]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        columns = [pa.array(some), pa.array(raw[some]), pa.array(target[some])]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "raw", "target"])

    return run


def _weigh(model: np.ndarray, span: int):
    def weights(column: pa.Array) -> np.ndarray:
        bucket, row = grams(column)
        n = np.bincount(row, minlength=len(column))
        return span * np.bincount(row, model[bucket], len(column)) / (n + PRIOR)

    return weights


def _labelled(labels: DataFrame, value: int, most: int, seed: int) -> np.ndarray:
    """At most ``most`` doc_ids of one class, the same in every run."""
    rows = labels.where((F.col("quality") == value) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    order = F.xxhash64("doc_id", F.lit(seed))
    return np.array([r[0] for r in rows.orderBy(order, "doc_id").limit(most).collect()], np.int64)


class Model:
    """Log ratio by bucket, and the log weight below which a document is rejected."""

    def __init__(self, ratio: np.ndarray, span: int = SPAN, threshold: float = -np.inf):
        self.ratio, self.span, self.threshold = ratio, span, threshold

    def score(self, docs: DataFrame, name: str = "log_weight", *, text: str = "text") -> DataFrame:
        """``docs`` with the log weight of each row as a further column; rows stay where they are."""
        shared, span, place = docs.sparkSession.sparkContext.broadcast(self.ratio), self.span, docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weigh = _weigh(shared.value, span)
            for batch in batches:
                plain = pa.RecordBatch.from_arrays([batch.column(place)], names=["text"])
                found = [weigh(part.column(0)) for part in tx.pieces(plain, "text")]
                values = pa.array(np.concatenate(found) if found else np.empty(0))
                yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])

        schema = docs.select("*", F.lit(0.0).alias(name)).schema
        return docs.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, *, most: int = LABELLED, span: int = SPAN, seed: int = 0) -> Model:
    """Count both models over ``docs`` and set the threshold on labelled rows."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    good, bad = _labelled(labels, 1, most, seed), _labelled(labels, 0, most, seed)
    counts = slim.mapInArrow(_count(good), "bucket long, raw long, target long")
    table = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table["bucket"]], target[table["bucket"]] = table["raw"], table["target"]
    raw, target = raw + SMOOTHING, target + SMOOTHING
    model = Model(np.log(target / target.sum()) - np.log(raw / raw.sum()), span)
    if not len(good) or not len(bad):
        return Model(np.zeros(BUCKETS), span)
    known = _chosen(spark, slim, np.concatenate([good, bad]))
    scored = model.score(known).select("doc_id", "log_weight").toPandas()
    is_good = np.isin(scored["doc_id"], good)
    model.threshold = cutoff(scored["log_weight"][is_good].to_numpy(), scored["log_weight"][~is_good].to_numpy())
    return model


def _chosen(spark: SparkSession, docs: DataFrame, ids: np.ndarray) -> DataFrame:
    """Rows of a bounded list of doc_ids, without moving any text."""
    shared = spark.sparkContext.broadcast(np.sort(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(np.isin(held, shared.value)))

    return docs.mapInArrow(run, docs.schema)


def cutoff(good: np.ndarray, bad: np.ndarray, loss: float = LOSS) -> float:
    """Threshold with the least sum of error shares that costs at most ``loss`` of the good; half way to the next value."""
    values = np.unique(np.concatenate([good, bad]))
    if not len(values):
        return -np.inf
    lost = np.searchsorted(np.sort(good), values, "left") / max(len(good), 1)
    passed = 1 - np.searchsorted(np.sort(bad), values, "left") / max(len(bad), 1)
    cost = np.where(lost <= loss, lost + passed, np.inf)
    best = int(np.argmin(cost))
    if best == 0:
        return -np.inf
    return float((values[best - 1] + values[best]) / 2)


def gumbel(doc_id: str = "doc_id", seed: int = 0):
    """A standard Gumbel draw for each doc_id."""
    u = (F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def top_k(scored: DataFrame, k: int, *, key: str = "sample_key", doc_id: str = "doc_id", parts: int | None = None) -> DataFrame:
    """``scored`` with ``selected``: is the row among the k largest keys? Equal keys go by doc_id, then at random.

    ``scored`` should be a written table. Rows are sorted by range; what the driver sees is one count per range.
    """
    rows = scored.sparkSession
    n = parts or max(1, int(rows.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col(key).desc(), F.col(doc_id).asc_nulls_last(), F.col("__tie")]
    work = WorkFolder(rows)
    ranged = scored.withColumn("__tie", F.rand(0)).repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id())
    ranged = work.keep("ranged", ranged.sortWithinPartitions(*order))
    sizes = {r["__part"]: r["n"] for r in ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, edge = 0, None
    for part in sorted(sizes):
        if before + sizes[part] > k:
            edge = part
            break
        before += sizes[part]
    if edge is None:
        return ranged.withColumn("selected", F.lit(True)).drop("__part", "__tie")
    inside = F.col("__part") < edge
    last = _first_rows(ranged.where(F.col("__part") == edge), order, k - before)
    return ranged.where(F.col("__part") != edge).withColumn("selected", inside).unionByName(last).drop("__part", "__tie")


def _first_rows(rows: DataFrame, order: list, k: int) -> DataFrame:
    """Mark the first k rows of one range, by a sort and a running number inside the only task that holds it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            taken = np.arange(seen, seen + batch.num_rows) < k
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(taken)], names=[*batch.schema.names, "selected"])

    schema = rows.select("*", F.lit(True).alias("selected")).schema
    return rows.coalesce(1).sortWithinPartitions(*order).mapInArrow(run, schema)


def resample(docs: DataFrame, model: Model, *, fraction: float | None = None, k: int | None = None, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, log_weight, accepted, sample_key, selected."""
    work = WorkFolder(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    scored = model.score(slim).select(
        "doc_id", "log_weight", (F.col("log_weight") >= F.lit(float(model.threshold))).alias("accepted"),
        (F.col("log_weight") + gumbel("doc_id", seed)).alias("sample_key"),
    )
    scored = work.keep("scored", scored)
    wanted = k if k is not None else round((1.0 if fraction is None else fraction) * scored.count())
    return top_k(scored, wanted)


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, unchanged; a draw would throw away good documents too."""
    mark = "__log_weight"
    return model.score(docs, mark).where(F.col(mark) >= F.lit(float(model.threshold))).drop(mark)
