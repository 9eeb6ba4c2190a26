"""Spelling variants against edit distances of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cropledger.llm import spelling


def occurrences(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 97 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            out[low] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    words = occurrences(rows)
    out, form = {}, {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = [n, len(near)]
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, *out[w], None if form[w] is None else words[form[w]])
    return sorted(out.values())


def check(docs, rows):
    assert sorted(tuple(r) for r in spelling.variants(docs).collect()) == brute(rows)


def mistyped(rng, word):
    for _ in range(rng.randrange(4)):
        k = rng.randrange(len(word) + 1)
        word = word[:k] + rng.choice(["", "e", "é", "ÿ"]) + word[k + rng.randrange(2) :]
    return word


def corpus(seed, documents=60, words=120):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(4, 9))) for _ in range(12)]
    pool = [mistyped(rng, rng.choice(stems)) for _ in range(400)]
    weights = [1 / (1 + k) for k in range(len(pool))]
    return [(k, rng.choice(" -,1×").join(w if rng.random() < 0.9 else w.upper() for w in rng.choices(pool, weights, k=words))) for k in range(documents)]


@pytest.mark.parametrize("slice_", [4096, 16, 3])
def test_all_pairs_of_mistyped_words(documents, monkeypatch, slice_):
    """Whether the vocabulary is one slice, many, or blocks of crowded ones."""
    rows = corpus(slice_)
    found = brute(rows)
    assert sum(r[4] for r in found) > 200 and any(r[1] and r[1] != r[2] for r in found)
    monkeypatch.setattr(spelling, "SLICE", slice_)
    check(documents(rows).repartition(5), rows)


def test_a_third_of_the_words_share_a_half(documents, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 20)
    rng = random.Random(5)
    words = ["inter" + "".join(rng.choice("ab") for _ in range(5)) for _ in range(60)] + [f"{a}{b}ling" for a in "abcdefgh" for b in "abcdefgh"]
    rows = [(k, " ".join(words)) for k in range(6)]
    check(documents(rows), rows)


def test_nulls_ties_repeated_rows_and_long_words(documents):
    long = "x" * 3000 + "y" * 3000
    rows = [
        (None, "abcde abcde abcde"), (1, None), (2, ""), (3, "abcdf Abcdf ABCDF"), (3, "abcdf Abcdf ABCDF"), (4, f"{long} {long} {long}"),
        (5, f"{long}z {long}z {long}z {long}z"), (6, f"{long[1:]} " * 8), (7, "aaaaa aaaaaa aaaaaaa " * 5), (8, "ÀÉÎõü àÉÎõü " * 9 + "straße " * 4),
    ]
    check(documents(rows), rows)


def test_words_of_letters_repeated_are_counted_once(documents):
    """Such pairs agree by both halves."""
    rows = [(k, "aaaaaa aaaaaaa aabaaa aaabaaa abababab babababa ababababa") for k in range(9)]
    check(documents(rows), rows)


def test_empty_table_and_clashing_columns(spark, documents):
    assert spelling.variants(documents([])).count() == 0
    rows = [(2, "fiver fiver fiver fever fever fever fever fever fever", "w", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    assert {r.word: r.root for r in spelling.variants(df).collect()} == {"fiver": "fever", "fever": "fever"}


def test_bitsets_of_every_width():
    rng = np.random.default_rng(0)
    for width in (1, 63, 64, 65, 200):
        rows = rng.random((3, width)) < 0.3
        row, at = spelling._ones(spelling._bits(rows))
        back = np.zeros_like(rows)
        back[row, at] = True
        assert (back == rows).all()


@pytest.mark.parametrize("cache", [1 << 18, 64, 8])
def test_words_against_an_index_in_one_process(monkeypatch, cache):
    monkeypatch.setattr(spelling, "BLOCK_BYTES", cache)
    rng = random.Random(cache)
    index = sorted({"".join(rng.choice("abé") for _ in range(rng.choice([5, 6]))) for _ in range(150)})
    words = [w for w in index if len(w) == 5]

    def spelled(names):
        return np.array([w.encode("latin-1") for w in names], "S6").view(np.uint8).reshape(len(names), 6)

    word, other = spelling.one_apart(spelled(index), spelled(words), 5)
    wanted = {(w, x) for w in words for x in index if one_edit(w, x)}
    assert {(words[a], index[b]) for a, b in zip(word, other)} == wanted and len(word) == len(wanted) > 100
