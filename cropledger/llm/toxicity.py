"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, trained from document labels.

A document is a bag of sentences. A sentence's score is the logistic of a bias plus the weights of its features: hashed
words and their first few bytes, so that an unseen form of a known stem counts too. A document is toxic unless every sentence is harmless, p = 1 - prod(1 - p_s). Labels exist for documents alone, yet the
gradient of that product goes to the sentences that explain the label, and so the model finds the offending ones.

Training takes at most ``SAMPLE`` labelled documents of each class, drawn by hash of the doc_id, to the driver; that
bound is the only sample here. A class weighs as the square root of its share among all training labels. Scoring reads
every whole text and never sees labels, language, source or doc_id.

Words are lower-cased runs of letters and digits; sentences end at . ! ? or a line break.

Defined results: a null or empty text has no sentence and scores 0. Rows that repeat a doc_id are scored one by one; a
null doc_id is not held out. Without training labels of both classes every score is the share of toxic labels, or 0. An
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.llm import text as tx

BUCKETS = 1 << 19
#: Beside whole words, their beginnings of so many bytes are features.
BEGINNINGS = (4, 5, 6, 7)
SAMPLE = 2_500
#: A feature counts if so many training documents have it; rarer ones only let the model learn documents by heart.
LEAST = 3
#: ... and its shares among toxic and other documents differ by so many standard deviations.
CLEAR = 4.0
STEPS = 120
RATE = 0.3
DECAY = 1e-4
START = -6.0
THRESHOLD = 0.7
#: A sentence at or above this probability is reported as offending.
OFFENDING = 0.5

SCORES = "doc_id long, score double, n_offending long, offending array<struct<start:long,end:long,score:double>>"
ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


def bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Feature buckets of each word (``BUCKETS`` where it has none), where each sentence with words starts among the words,
    the row of each sentence, its span in bytes."""
    data, offsets = tx.flat(column)
    start, length = tx.runs(data, offsets, tx.WORDS_ONLY)
    bucket = np.full((len(start), 1 + len(BEGINNINGS)), BUCKETS, np.int32)
    bucket[:, 0] = tx.hashes(data, start, length) & np.uint64(BUCKETS - 1)
    for k, n in enumerate(BEGINNINGS, 1):
        some = np.flatnonzero(length > n)
        part = tx.hashes(data, start[some], np.full(len(some), n))
        bucket[some, k] = tx.mix(part + np.uint64(k)) & np.uint64(BUCKETS - 1)
    row = tx.owners(offsets, start)
    ended = np.concatenate([[0], np.cumsum(ENDS[data])])[start] if len(start) else start
    new = np.flatnonzero((np.diff(ended, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    last = np.append(new[1:], len(start)) - 1 if len(new) else new
    base = offsets[row[new]]
    return bucket, new, row[new], (start[new] - base, start[last] + length[last] - base)


def _soft(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _logits(model: np.ndarray, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log odds of each sentence; the model's last two numbers are the weight of no feature, 0, and the bias."""
    if not len(first):
        return np.empty(0)
    words = sum(model[bucket[:, k]] for k in range(bucket.shape[1]))
    return model[-1] + np.add.reduceat(words, first)


def train(bucket: np.ndarray, first: np.ndarray, row: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights by bucket. Adagrad on the whole sample; the loss is the weighted log loss of noisy-or."""
    sentence = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(bucket))))
    some, toxic = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)  # documents that have a feature
    for k in range(bucket.shape[1]):
        document, feature = np.divmod(np.unique(row[sentence] * np.int64(BUCKETS + 1) + bucket[:, k]), BUCKETS + 1)
        some += np.bincount(feature, minlength=BUCKETS + 1)
        toxic += np.bincount(feature, label[document] == 1, BUCKETS + 1)
    n, n1 = len(label), int((label == 1).sum())
    spread = np.sqrt(np.maximum(some / n * (1 - some / n), 1e-12) * (1 / n1 + 1 / max(n - n1, 1)))
    known = (some >= LEAST) & (np.abs(toxic / n1 - (some - toxic) / max(n - n1, 1)) >= CLEAR * spread)
    known[BUCKETS] = False
    held = known[bucket]
    of, feature = np.broadcast_to(sentence[:, None], bucket.shape)[held], bucket[held]
    used, place = np.unique(feature, return_inverse=True)
    w, b = np.zeros(len(used)), START
    seen_w, seen_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(STEPS):
        z = b + np.bincount(of, w[place], len(first))
        total = np.bincount(row, _soft(z), len(label))
        # d loss / d total: 1 for a harmless label, -1 / (e^total - 1) for a toxic one
        slope = np.where(label == 1, -1.0 / np.maximum(np.expm1(np.minimum(total, 50.0)), 1e-6), 1.0) * weight
        push = slope[row] / (1.0 + np.exp(np.minimum(-z, 500.0)))
        grad = np.bincount(place, push[of], len(used)) + DECAY * w * weight.sum()
        seen_w += grad**2
        w -= RATE * grad / np.sqrt(seen_w)
        g = float(push.sum())
        seen_b += g**2
        b -= 0.1 * g / np.sqrt(seen_b)
    model = np.zeros(BUCKETS + 2)
    model[used], model[-1] = w, b
    return model


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: a third of all ids, by checksum of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bags_of(chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(np.isin(ids, chosen.value) & ~np.asarray(batch.column("doc_id").is_null())))
            for part in tx.pieces(batch, "text"):
                bucket, first, row, _ = bags(tx.lower(part.column("text")))
                edges = np.searchsorted(row, np.arange(part.num_rows + 1))
                starts = np.append(first, len(bucket))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([bucket[starts[a] : starts[b]].astype("<i4").tobytes() for a, b in zip(edges, edges[1:])]),
                        pa.array([np.diff(starts[a : b + 1]).astype("<i4").tobytes() for a, b in zip(edges, edges[1:])]),
                    ],
                    names=["doc_id", "buckets", "sizes"],
                )

    return run


def fit(docs: DataFrame, labels: DataFrame, *, most: int = SAMPLE, seed: int = 0) -> np.ndarray:
    """Train on a bounded sample of the labels that are not held out."""
    spark = docs.sparkSession
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen: dict[int, int] = {}
    for value in (0, 1):
        rows = usable.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(most)
        chosen |= {r["doc_id"]: value for r in rows.select("doc_id").collect()}
    share = totals.get(1, 0) / max(sum(totals.values()), 1)
    model = np.zeros(BUCKETS + 2)
    model[-1] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
    if not all(totals.get(v) for v in (0, 1)):
        return model
    ids = spark.sparkContext.broadcast(np.array(sorted(chosen), np.int64))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    found = slim.mapInArrow(_bags_of(ids), "doc_id long, buckets binary, sizes binary").toArrow()
    known = [d for d, s in zip(found["doc_id"].to_pylist(), found["sizes"].to_pylist()) if s]
    bucket = np.frombuffer(b"".join(found["buckets"].to_pylist()), "<i4").reshape(-1, 1 + len(BEGINNINGS))
    sizes = [np.frombuffer(x, "<i4") for x in found["sizes"].to_pylist() if x]
    if not sizes:
        return model
    label = np.array([chosen[d] for d in known])
    taken = {v: max(int((label == v).sum()), 1) for v in (0, 1)}
    # Back to the classes' shares, then half way (in powers) to equal shares, so that the rarer class is not talked down.
    weight = np.array([totals[v] ** 0.5 / taken[v] for v in label.tolist()])
    every = np.concatenate(sizes)
    row = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes])
    return train(bucket, np.cumsum(every) - every, row, label, weight * len(label) / weight.sum())


def _characters(text: bytes, at: list[int]) -> list[int]:
    """Byte positions, ascending, as code points."""
    out, done, held = [], 0, 0
    for k in at:
        held += len(text[done:k].decode("utf-8", "replace"))
        done = k
        out.append(held)
    return out


def _score(shared, offending: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in tx.pieces(batch, "text"):
                low = tx.lower(part.column("text").fill_null(""))
                bucket, first, row, (start, end) = bags(low)
                z = _logits(model, bucket, first)
                score = -np.expm1(-np.bincount(row, _soft(z), part.num_rows))
                bad = np.flatnonzero(z >= np.log(offending / (1 - offending)))
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for doc in np.unique(row[bad]).tolist():
                    own = bad[row[bad] == doc]
                    points = np.stack([start[own], end[own]], 1).ravel().tolist()
                    points = _characters(low[doc].as_py().encode(), points)
                    chance = (1 / (1 + np.exp(np.minimum(-z[own], 500.0)))).tolist()
                    spans[doc] = [
                        {"start": a, "end": b, "score": p} for a, b, p in zip(points[::2], points[1::2], chance)
                    ]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(score), pa.array([len(s) for s in spans], pa.int64()),
                        pa.array(spans, kind),
                    ],
                    names=["doc_id", "score", "n_offending", "offending"],
                )

    return run


def score(docs: DataFrame, model: np.ndarray, *, threshold: float = THRESHOLD, offending: float = OFFENDING) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_offending, offending spans in the lower-cased text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    scored = slim.mapInArrow(_score(shared, offending), SCORES)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_offending", "offending",
    )
