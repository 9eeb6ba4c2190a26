"""Noisy-or over sentences: the gradient, held-out accuracy, the sentences found."""

import zlib

import numpy as np
import pyarrow as pa

from cropledger.llm import toxicity as tox
from cropledger.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op7_noisy_or_toxicity"](spark, sf).select("doc_id", "held_out", "score", "predicted").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(k).encode()) % 3 == 1 for k in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.7)).all()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    toxic, rank = both["toxic"] == 1, both["score"].rank()
    pairs = toxic.sum() * (~toxic).sum()
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / pairs
    assert auc > 0.95
    assert (both["predicted"][toxic] == 1).mean() > 0.75 and (both["toxic"][both["predicted"] == 1] == 1).mean() > 0.9


def train_ids(n):
    return [k for k in range(10**6) if zlib.crc32(str(k).encode()) % 3 != 1][:n]


def corpus(spark, extra=()):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in train_ids(600):
        sentences = [" ".join(f"word{rng.integers(300)}" for _ in range(8)) for _ in range(6)]
        bad = k % 4 == 0
        if bad:
            sentences[rng.integers(6)] += " vilething"
        rows.append((k, ". ".join(sentences) + "."))
        labels.append((k, 1, int(bad)))
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_finds_the_sentence_and_unseen_forms_of_its_stem(spark):
    held = next(k for k in range(10**6, 10**7) if zlib.crc32(str(k).encode()) % 3 == 1)
    extra = [(held, "Éa fine one! You VILETHING there. Word1 word2."), (None, "vilething"), (5_000_001, "vilethinger"), (7_000_000, None), (7_000_001, ""), (7_000_002, "word1 " * 100_000)]
    docs, labels = corpus(spark, extra)
    got = {r.doc_id: r for r in tox.score(docs, tox.fit(docs, labels)).collect()}
    row = got[held]
    assert row.held_out and row.predicted == 1 and row.n_offending == 1
    span = row.offending[0]
    assert "éa fine one! you vilething there. word1 word2."[span["start"] : span["end"]] == "you vilething there"
    assert got[None].predicted == 1 and got[None].held_out is False
    assert got[5_000_001].score > 0.5
    assert got[7_000_000].score == got[7_000_001].score == 0.0
    assert got[7_000_002].predicted == 0


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = corpus(spark)
    held = [(k, f"nastyword alone {k}", 1) for k in range(9 * 10**6, 9 * 10**6 + 400) if zlib.crc32(str(k).encode()) % 3 == 1]
    more = labels.unionByName(spark.createDataFrame([(k, 1, y) for k, _, y in held], LABELS))
    both = docs.unionByName(spark.createDataFrame([(k, t) for k, t, _ in held], "doc_id long, text string"))
    assert np.array_equal(tox.fit(docs, labels), tox.fit(both, more))


def test_training_lowers_the_loss_of_noisy_or(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [". ".join(" ".join(f"w{rng.integers(20)}" for _ in range(4)) for _ in range(3)) for _ in range(60)]
    label = np.array([int("w7" in t.replace(".", "").split()) for t in texts])
    bucket, first, row, _ = tox.bags(pa.array(texts))
    monkeypatch.setattr(tox, "CLEAR", 0.0)

    def loss(model):
        total = np.bincount(row, np.logaddexp(0, tox._logits(model, bucket, first)), 60)
        p = np.clip(-np.expm1(-total), 1e-12, 1 - 1e-12)
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).sum()

    losses = []
    for steps in (1, 30, 300):
        monkeypatch.setattr(tox, "STEPS", steps)
        losses.append(loss(tox.train(bucket, first, row, label, np.ones(60))))
    assert losses[0] > 2 * losses[1] > 4 * losses[2] and losses[2] < 3


def test_missing_classes_repeats_and_empty_tables(spark, documents):
    docs = documents([(1, "a b."), (1, "a b."), (None, None)])
    none = spark.createDataFrame([], LABELS)
    got = tox.score(docs, tox.fit(docs, none)).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1e-6 for r in got)
    one = spark.createDataFrame([(k, 1, None) for k in range(3)] + [(k, 1, 0) for k in range(9)], LABELS)
    assert tox.score(documents([]), tox.fit(documents([]), one)).count() == 0


def test_bags():
    bucket, first, row, (start, end) = tox.bags(pa.array(["one two. three!\nfour", "", "... five"]))
    assert len(bucket) == 5 and first.tolist() == [0, 2, 3, 4] and row.tolist() == [0, 0, 0, 2]
    assert start.tolist() == [0, 9, 16, 4] and end.tolist() == [7, 14, 20, 8]
