"""Exact duplicates against grouping in Python."""

import hashlib
import re

from cropledger.llm import exact_dedup


def brute(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    out = []
    for (doc, _), text in zip(rows, norm):
        ids = [d for (d, _), t in zip(rows, norm) if t == text]
        known = [d for d in ids if d is not None]
        out.append((doc, min(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def check(df, rows):
    got = exact_dedup.classes(df).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_white_space_nulls_ties_and_long_texts(documents):
    long = "word " * 200_000
    rows = [
        (3, "a  b"), (1, "a\tb"), (2, "a b"), (9, " a b"), (4, None), (5, ""), (6, " "), (7, "\n\t "), (8, long), (0, long),
        (10, "a b"), (11, "é"), (12, "é"), (3, "a b"), (3, "c"), (None, "c"), (None, "only"), (None, "only"),
    ]
    check(documents(rows), rows)


def test_hot_group_over_many_partitions(documents):
    rows = [(k, "the same" if k % 3 else f"own {k}") for k in range(600)]
    check(documents(rows).repartition(40), rows)


def test_equal_digests_of_different_texts_stay_apart(spark, monkeypatch):
    """Were two texts to share a digest, their content would still tell them apart."""
    real = exact_dedup.F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: real(exact_dedup.F.lit("same"), bits))
    df = spark.createDataFrame([(k, f"text {k % 3}") for k in range(30)], "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.classes(df).collect()}
    assert found == {k: (k % 3, 10) for k in range(30)}


def test_empty_table_and_clashing_columns(spark, documents):
    assert exact_dedup.classes(documents([])).count() == 0
    df = spark.createDataFrame([(1, "x", 5, "k"), (2, "x", 6, "l")], "doc_id long, text string, keep_id int, digest string")
    assert {(r.doc_id, r.keep_id) for r in exact_dedup.classes(df).collect()} == {(1, 1), (2, 1)}
    kept = exact_dedup.keep_one(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "x", 5, "k")]


def test_keep_one_of_repeated_rows(documents):
    rows = [(1, "x"), (1, "x"), (1, "y"), (2, "y "), (None, "z"), (None, "z"), (3, None), (4, "")]
    kept = exact_dedup.keep_one(documents(rows)).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(1, "x"), (1, "y"), (2, "y "), (None, "z"), (3, None)]))
