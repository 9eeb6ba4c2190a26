"""Signatures estimate weighted Jaccard similarity; classes equal those of all pairs compared one by one."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from cropledger.llm import dart_minhash as dm
from cropledger.llm.queries import QUERIES


def bag(text):
    words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def brute(rows, least=0.8):
    """Class of each row as the set of its row numbers: connected by pairs at or above the similarity."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= least:
                parent[top(i)] = top(j)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(top(k), []).append(k)
    out = []
    for members in groups.values():
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        for k in members:
            out.append((rows[k][0], min(ids) if ids else None, len(members)))
    return sorted(out, key=str)


def found(df):
    return sorted([(r.doc_id, r.class_id, r.class_size) for r in dm.classes(df).collect()], key=str)


def words(draw, n):
    return [f"w{draw.randrange(10**6)}" for _ in range(n)]


def test_real_documents(spark, real):
    rows = [(r.doc_id, r.text) for r in real("documents").select("doc_id", "text").collect()]
    got = QUERIES["op3_dart_minhash"](spark, "/root/testdata/sf0.001").collect()
    assert sorted([(r.doc_id, r.class_id, r.class_size) for r in got], key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_chains_stars_copies_and_odd_texts(documents):
    draw = random.Random(5)
    rows, number = [], 0

    def add(text):
        nonlocal number
        rows.append((number, text))
        number += 1

    for _ in range(12):  # a base and copies of it with a few words changed
        base = words(draw, draw.randrange(60, 200))
        add(" ".join(base))
        for _ in range(draw.randrange(1, 6)):
            copy = list(base)
            for _ in range(draw.randrange(0, 3)):
                copy[draw.randrange(len(copy))] = "changed"
            add(" ".join(copy))
    chain = words(draw, 120)  # each similar to the next, the ends are not
    for _ in range(8):
        add(" ".join(chain))
        chain = [*chain[6:], *words(draw, 6)]
    shared = words(draw, 60)  # a passage in many texts that are not similar
    for _ in range(30):
        add(" ".join(shared + words(draw, 100)))
    for text in (None, "", " ", "!!", "one two", "One, two!", "one two three four five", "tick " * 300, "tick " * 301, "tick " * 200, "long " * 50_000):
        add(text)
    rows += [(None, rows[0][1]), (None, "nobody else"), (3, "nobody but three"), (0, rows[0][1])]
    draw.shuffle(rows)
    assert found(documents(rows).repartition(7)) == brute(rows)


def test_one_large_group_of_near_copies(documents):
    draw = random.Random(6)
    base = words(draw, 150)
    rows = []
    for k in range(400):
        copy = list(base)
        for _ in range(3):
            copy[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    rows += [(1000 + k, " ".join(words(draw, 150))) for k in range(100)]
    assert found(documents(rows).repartition(9)) == brute(rows)


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(7)
    agreed, true = [], []
    for _ in range(30):
        n = int(draw.integers(5, 200))
        element = draw.integers(1, 2**62, n).astype(np.uint64)
        a, b = draw.uniform(0, 4, n), draw.uniform(0, 4, n)
        a[draw.random(n) < 0.2] = 0
        keep = b > 0.3
        b[~keep] = 0
        both = [(element[w > 0], np.zeros((w > 0).sum(), np.int64), w[w > 0]) for w in (a, b)]
        one, two = (dm.signatures(*x, 1, 600)[0] for x in both)
        agreed.append((one == two).mean())
        true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    error = np.array(agreed) - np.array(true)
    assert abs(error.mean()) < 0.015 and np.abs(error).max() < 0.1


def test_same_signature_whatever_the_batch():
    texts = ["a b c d e f g", "x", "", "a b c d e f g " * 40]
    value, of, times, _ = dm.shingles(pa.array(texts))
    together = dm.signatures(value, of, times.astype(float), 4, 100)
    for k, text in enumerate(texts):
        value, of, times, _ = dm.shingles(pa.array([text]))
        assert (dm.signatures(value, of, times.astype(float), 1, 100)[0] == together[k]).all()


def test_empty_table_and_clashing_columns(spark, documents):
    assert dm.classes(documents([])).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f", "n", 2), (2, "a b c d e f", "m", 3), (None, "a b c d e f", "m", 3)], "doc_id long, text string, node string, id int")
    kept = dm.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "None"]


def test_components(spark):
    from cropledger.session import WorkFolder

    draw = random.Random(8)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100 + draw.randrange(40), 100 + draw.randrange(40)) for _ in range(30)] + [(200, k) for k in range(201, 260)]
    got = {r.node: r.root for r in dm.components(spark.createDataFrame(edges, "a long, b long"), WorkFolder(spark), "c").collect()}
    parent = {}

    def top(k):
        while parent.get(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    for a, b in edges:
        for k in (a, b):
            assert got.get(k, k) == top(k)
