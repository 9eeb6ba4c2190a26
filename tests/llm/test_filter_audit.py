"""The filter audit against applying every order of filters in Python."""

import itertools
import random
import re
from collections import Counter

import pytest

from cropledger.llm import filter_audit


def broken(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search("[#$%&*|]", text)),
    )


def brute(rows, labels):
    """rows: (doc_id, text, source); labels: {doc_id: (quality, toxic)}"""
    docs = []
    for doc, text, source in rows:
        ids = [d for d, t, _ in rows if (t or "") == (text or "") and d is not None]
        e = bool(ids) and (doc is None or doc > min(ids))
        docs.append((source or "", dict(zip("ABCDE", (*broken(text or ""), e))), *labels.get(doc, (None, None))))
    out, removed_in = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                redundant = sum(d[1][f] for d in own) - len(gone)
                left = [d for d in left if not d[1][f]]
                unique = sum(d[1][f] and sum(d[1].values()) == 1 for d in own)
                out[part, order, step] = [
                    len(left), len(gone), redundant, unique, sum(d[2] == 1 for d in gone), sum(d[3] == 1 for d in gone)
                ]
                removed_in[part, f] += len(gone)
    return {k: (*v, removed_in[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def check(spark, rows, labels):
    docs = spark.createDataFrame([(t, s, d, 1) for d, t, s in rows], "text string, source string, doc_id long, mask int").repartition(3)
    known = spark.createDataFrame([(d, *x) for d, x in labels.items()], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, known).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:10] for r in got}
    assert len(found) == len(got) and found == brute(rows, labels)


def text(rng, words):
    return " ".join(rng.choice(["Alpha", "beta", "GAMMA", "x$", "y", f"w{rng.randrange(10**6)}"]) for _ in range(words))


def test_every_order_of_random_documents(spark):
    rng = random.Random(1)
    pool = [text(rng, rng.choice([0, 1, 150, 199, 200, 201, 400])) for _ in range(30)] + [" ".join(f"u{k}" for k in range(300))]
    rows = [(k, rng.choice(pool), rng.choice(["a", "b", None])) for k in range(90)]
    rng.shuffle(rows)
    labels = {k: (rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 120, 2)}
    check(spark, rows, labels)


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    long = "one Two three " * 100_000
    rows = [
        (1, None, None), (2, "", ""), (3, long, "s"), (3, long, "s"), (9, long, "s"), (None, long, "t"), (None, "own", "t"),
        (None, "own", "t"), (5, "own word | É", "t"), (6, " ", "t"), (7, "\t", "t"),
    ]
    check(spark, rows, {1: (1, 1), 3: (1, 0), 9: (None, 1)})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0


@pytest.mark.parametrize("cells", [1 << 23, 64])
def test_no_repeat_is_ever_cleared(spark, monkeypatch, cells):
    """Neither with room, where hardly any single key is left, nor in crowded slices."""
    monkeypatch.setattr(filter_audit, "SLICE_CELLS", cells)
    keys = spark.range(20_000).selectExpr("xxhash64(id) AS key")
    again = keys.where("key % 10 = 0")
    both = keys.union(again).repartition(7)
    wanted = {r.key for r in again.collect()}
    found = [r.key for r in filter_audit.possible_repeats(both, both.count()).collect()]
    assert len(found) == len(set(found)) and wanted <= set(found)
    assert len(found) < len(wanted) + 2_000


def test_few_keys_may_be_broadcast_and_many_join_by_key(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "MOST_KEYS", 0)
    rows = [(k, f"text {k % 4}", "s") for k in range(12)]
    check(spark, rows, {})
