"""Passages found: against containment and a plain edit distance; recall at the edits allowed."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cropledger.llm import decontaminate as dc
from cropledger.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def plain(pattern, text):
    """Least edit distance of pattern to a part of text, by the table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row[0] = row[:], i
        for j, d in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d))
    return min(row)


def edited(draw, text, times):
    out = list(text)
    for _ in range(times):
        k = draw.randrange(len(out))
        out[k : k + 1] = draw.choice([[], [draw.choice("xyz ")], [out[k], draw.choice("xyz")]])
    return "".join(out)


@settings(max_examples=300, deadline=None)
@given(st.text("abé", min_size=1, max_size=12), st.text("abé", max_size=30))
def test_ends_is_the_edit_distance(pattern, text):
    distance, end = dc.ends(pattern, text)
    assert distance == plain(pattern, text) and plain(pattern, text[:end]) == distance


def test_real_documents(spark, real):
    items = {r.item_id: " ".join(r.text.lower().split()) for r in real("benchmark").collect()}
    docs = {r.doc_id: " ".join(r.text.lower().split()) for r in real("documents").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op4_cgk_decontamination"](spark, "/root/testdata/sf0.001").collect()}
    assert {k for k, d in got.items() if d == 0} == {(d, i) for d, t in docs.items() for i, p in items.items() if p in t}
    for (doc, item), distance in got.items():
        assert distance == dc.ends(items[item], docs[doc])[0] <= int(0.1 * len(items[item]))


def test_recall_at_the_edits_allowed(real):
    draw = random.Random(9)
    index = dc.Index([(r.item_id, r.text) for r in real("benchmark").collect()])
    filler = [" ".join(r.text.lower().split()) for r in real("documents").limit(100).collect()]
    docs, want = [], []
    for k in range(400):
        item = k % len(index.texts)
        limit = index.limit(item)
        doc = f"{filler[k % 97][:400]} {edited(draw, index.texts[item], limit)} {filler[k % 89][:400]}"
        docs.append(doc)
        if dc.ends(index.texts[item], doc)[0] <= limit:
            want.append((k, item))
    got = {(r[0], r[1]) for r in index.search(pa.array(docs))}
    assert len(want) > 300 and sum(w in got for w in want) / len(want) >= 0.95


def test_places_case_space_and_short_items(spark):
    items = [(1, "The Quick  brown\nfox jumps over the lazy dog again and again"), (2, "zq"), (3, None), (4, ""), (5, "zq"), (None, "é" * 40)]
    docs = [
        (1, "x the quick brown fox jumps over the lazy dog AGAIN and again"), (2, "has zq inside"), (3, None), (4, ""),
        (5, "THE QUICK BROWN\n\n FOX JUMPS OVER THE LAZI DOG AGAIN AND AGAIN"), (None, "É" * 40), (7, "nothing " * 50_000 + "zq"), (2, "zq zq"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.find(df, spark.createDataFrame(items, ITEMS)).collect()
    found = {(r.doc_id, r.item_id, r.distance, r.start, r.end) for r in got}
    size = len(" ".join(items[0][1].split()))
    assert (1, 1, 0, 2, 2 + size) in found and (5, 1, 1, 0, size) in found
    assert {(2, 2), (2, 5), (7, 2), (7, 5), (None, None)} <= {f[:2] for f in found}
    assert {f[0] for f in found} == {1, 2, 5, 7, None}
    # bytes of an upper-case word across a line: only the first of a repeated item counts
    assert sum(r.doc_id == 2 for r in got) == 4


def test_empty_tables_and_blocks(spark, documents, monkeypatch):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(k, f"item number {k} with words of its own {k * 7919}") for k in range(40)], ITEMS)
    assert dc.find(documents(["a"]), none).count() == 0
    assert dc.find(documents([]), some).count() == 0
    docs = documents([f"before item number {k} with words of its own {k * 7919} after" for k in range(40)])
    monkeypatch.setattr(dc, "EDITS", 0.0)
    whole = {(r.doc_id, r.item_id) for r in dc.find(docs, some, edits=0.0).collect()}
    assert whole == {(k, j) for k in range(40) for j in range(40) if f"number {j} with words of its own {j * 7919} " in f"before item number {k} with words of its own {k * 7919} after" or f"item number {j} with words of its own {j * 7919}" in f"item number {k} with words of its own {k * 7919}"}
    monkeypatch.setattr(dc.blocks, "__defaults__", (400,))
    assert {(r.doc_id, r.item_id) for r in dc.find(docs, some, edits=0.0).collect()} == whole
    with pytest.raises(ValueError, match="a block holds"):
        list(dc.blocks(some, "item_id", "text", 10))


def test_keep_clean_returns_rows_unchanged(spark):
    df = spark.createDataFrame([(1, 9, "the item is here: alpha beta gamma delta"), (2, 8, "clean"), (None, 7, None), (2, 8, "clean")], "item_id long, distance int, text string")
    clean = dc.keep_clean(spark, df, spark.createDataFrame([(1, "alpha beta gamma delta")], ITEMS))
    assert clean.columns == df.columns
    assert sorted(map(str, map(tuple, clean.collect()))) == sorted(map(str, [(2, 8, "clean"), (2, 8, "clean"), (None, 7, None)]))


def test_verbatim_passages_in_unspaced_text_and_behind_marks():
    draw = random.Random(5)
    for low, high in ((0x4E00, 0x9F00), (0x3041, 0x3090), (0x0E01, 0x0E2E)):
        def run(n, low=low, high=high):
            return "".join(chr(draw.randrange(low, high)) for _ in range(n))
        items = [run(n) for n in (11, 12, 16, 25, 40, 90, 200)]
        docs = [f"{run(57)}{item}{run(61)}" for item in items]
        got = {(r[0], r[1], r[2]) for r in dc.Index(list(enumerate(items))).search(pa.array(docs))}
        assert {(k, k, 0) for k in range(len(items))} <= got
    items = [f"{'abcdefgh'[k]}orematicallyinterwovenitems of {k}{'x' * k}" for k in range(5)]
    assert all(32 <= len(item) <= 40 for item in items)
    for before in ('"', "(", "Q:", "[", "“", "«", "-", "、", "x'"):
        got = {(r[0], r[1], r[2]) for r in dc.Index(list(enumerate(items))).search(pa.array([f"so {before}{item}" for item in items]))}
        assert {(k, k, 0) for k in range(len(items))} <= got, before


@pytest.mark.parametrize("size", [20, 25, 32, 36, 45, 60, 80])
def test_recall_of_short_items(size):
    draw = random.Random(size)
    words = ["".join(draw.choice("etaoinshrdlucm") for _ in range(draw.randint(2, 9))) for _ in range(3000)]

    def text(n):
        return " ".join(draw.choice(words) for _ in range(n))[:n].strip().ljust(n, "a")

    items = [text(size) for _ in range(100)]
    index = dc.Index(list(enumerate(items)))
    docs = [f"{text(200)} {edited(draw, item, index.limit(k))} {text(200)}" for k, item in enumerate(items)]
    want = [k for k, doc in enumerate(docs) if dc.ends(items[k], " ".join(doc.split()))[0] <= index.limit(k)]
    got = {(r[0], r[1]) for r in index.search(pa.array(docs))}
    assert sum((k, k) in got for k in want) / len(want) >= 0.95
