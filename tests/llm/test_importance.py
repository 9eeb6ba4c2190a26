"""Models against counting in Python, the draw against sorting, the classifier on labelled rows."""

import re

import numpy as np
import pyarrow as pa

from cropledger.llm import importance as im
from cropledger.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def test_grams_are_runs_and_neighbours():
    bucket, row = im.grams(pa.array(["a b!! a", None, "a b"]))
    assert np.bincount(row, minlength=3).tolist() == [7, 0, 3]
    first, last = sorted(bucket[row == 0].tolist()), sorted(bucket[row == 2].tolist())
    assert set(last) <= set(first)  # a, b and "a b" are the same in both


def test_log_ratio_of_counts(spark):
    texts = {k: t for k, t in enumerate(["good words here", "good words there", "bad!! BAD!! words", "good", None, ""] * 5)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int("BAD" not in (t or "") and bool(t)), 0) for k, t in texts.items() if t], LABELS)
    model = im.fit(docs, labels)

    def grams(t):
        runs = re.findall(r"\w+|[^\w\s]+", t or "")
        return im.grams(pa.array([" ".join(runs) if t else ""]))[0]

    raw, target = np.ones(im.BUCKETS), np.ones(im.BUCKETS)
    for t in texts.values():
        np.add.at(raw, grams(t), 1)
        if t and "BAD" not in t:
            np.add.at(target, grams(t), 1)
    assert np.allclose(model.ratio, np.log(target / target.sum()) - np.log(raw / raw.sum()))
    got = {r.doc_id: r for r in im.resample(docs, model, k=7).collect()}
    for k, t in texts.items():
        g = grams(t)
        assert np.isclose(got[k].log_weight, im.SPAN * model.ratio[g].sum() / (len(g) + im.PRIOR))
        assert got[k].accepted == ("BAD" not in (t or ""))
    assert sum(r.selected for r in got.values()) == 7
    best = sorted(got.values(), key=lambda r: -r.sample_key)[:7]
    assert all(r.selected for r in best)


def test_top_k_with_ties_repeats_and_any_k(spark):
    rows = [(k % 10, float(k % 4)) for k in range(60)] + [(None, 2.0)] * 5
    scored = spark.createDataFrame(rows, "doc_id long, sample_key double")
    for k in (0, 1, 17, 64, 65, 100):
        got = im.top_k(scored, k).collect()
        assert len(got) == 65 and sum(r.selected for r in got) == min(k, 65)
        chosen = sorted((r.sample_key for r in got if r.selected), reverse=True)
        assert chosen == sorted((r[1] for r in rows), reverse=True)[:k]


def test_the_draw_follows_the_weights(spark):
    """Gumbel top-1 picks a row with the share of its weight."""
    picked = 0
    for seed in range(60):
        rows = spark.range(2).selectExpr("id AS doc_id").withColumn("key", im.F.when(im.F.col("doc_id") == 0, np.log(3.0)).otherwise(0.0) + im.gumbel("doc_id", seed))
        picked += rows.orderBy(im.F.desc("key")).first().doc_id == 0
    assert 33 <= picked <= 56  # 45 expected, 3.4 standard deviations each way


def test_real_labels(spark, real):
    got = {r.doc_id: r for r in QUERIES["op6_importance_resampling"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [got[r.doc_id].accepted for r in labels if r.quality == 1]
    bad = [got[r.doc_id].accepted for r in labels if r.quality == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1
    assert sum(r.selected for r in got.values()) == round(0.5 * len(got))


def test_nulls_missing_labels_and_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    docs = documents([(1, None), (1, "x"), (None, ""), (4, "long words " * 100_000)])
    model = im.fit(docs, none)
    assert im.keep_accepted(docs, model).count() == 4
    got = im.resample(docs, model, fraction=1.0).collect()
    assert len(got) == 4 and all(r.selected and r.accepted and r.log_weight == 0 for r in got)
    some = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (4, 0, None), (4, 0, 1)], LABELS)
    assert im.resample(documents([]), im.fit(documents([]), some)).count() == 0


def test_stage_returns_rows_unchanged(spark):
    df = spark.createDataFrame([(1, 0.5, "fine words"), (2, None, "junk!! junk!!")], "doc_id long, log_weight double, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], LABELS)
    kept = im.keep_accepted(df, im.fit(df, labels))
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, 0.5, "fine words")]


def test_cutoff():
    assert im.cutoff(np.array([2.0, 3.0]), np.array([-1.0, 0.0])) == 1.0
    assert im.cutoff(np.array([1.0]), np.array([])) == -np.inf
    good = np.concatenate([np.full(999, 5.0), [-9.0]])
    assert im.cutoff(good, np.array([-10.0, -8.0, -3.0])) == 1.0
