"""Packing: ids equal to tokenizers, every id once, fills checked against all subsets."""

import itertools
import json
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cropledger.llm import packing
from cropledger.llm.queries import QUERIES

PATH = public_tokenizers.path(packing.VOCABULARY)


TOKENIZER = Tokenizer.from_file(str(PATH))
LITERAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def reference():
    return lambda text: [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_same_ids_as_tokenizers(text):
    assert packing.encoder(str(PATH))(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from([LITERAL, LITERAL[:-1], LITERAL[1:], " ", "<|", "\n"])), max_size=12).map("".join))
def test_same_ids_with_literals_of_added_tokens(text):
    assert packing.encoder(str(PATH))(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_a_literal_is_one_id():
    assert packing.encoder(str(PATH))("a <|endoftext|> x") == [64, 220, 50256, 2124]


@pytest.mark.parametrize("change", [{"lstrip": True}, {"rstrip": True}, {"single_word": True}, {"content": "<|endoftext|><|"}, {"content": "|>a"}])
def test_same_ids_with_other_added_tokens(tmp_path, change):
    spec = json.loads(Path(PATH).read_text())
    spec["added_tokens"].append({**spec["added_tokens"][0], "id": 50257, "content": "<extra>", **change})
    path = tmp_path / "vocabulary.json"
    path.write_text(json.dumps(spec))
    plain, mine = Tokenizer.from_file(str(path)), packing.encoder(str(path))
    for text in ("a <extra> b", "<extra>x", f"{LITERAL}<|{LITERAL}", f"a{LITERAL}a |>a <extra>", "nothing here"):
        assert mine(text) == plain.encode(text, add_special_tokens=False).ids


def test_same_ids_on_hard_texts(reference):
    for text in ["a" * 50_000, " " * 20_000 + "x", "\n" * 9_000, "!" * 5_000, "<|endoftext|> x", "it's I'LL don't", "İ﻿‍\U0001f600"]:
        assert [*packing.encoder(str(PATH))(text), 0] == reference(text)


def invariants(rows, texts, reference, capacity=1024):
    """Pieces cover every id of every document once; sequences are gapless and never too long."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array(reference(texts[doc]), "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    sizes = [sum(n for _, n in parts) for parts in sequences.values()]
    return sum(capacity - n for n in sizes if n & (n - 1)) / sum(sizes)


def test_query_on_real_texts(spark, real, reference):
    rows = QUERIES["op8_bin_slack_packing"](spark, "/root/testdata/sf0.001").collect()
    waste = invariants(rows, {r.doc_id: r.text for r in real("documents").collect()}, reference)
    assert waste < 0.02


def test_nulls_empty_long_and_equal_texts(documents, reference):
    texts = dict(enumerate([None, "", "word", "word", "long words " * 40_000, "x", " "]))
    rows = packing.pack(documents(list(texts.items())).repartition(3)).collect()
    invariants(rows, texts, reference)
    assert packing.pack(documents([])).count() == 0
    assert packing.pack(documents([(1, "a"), (1, "a"), (None, "b")])).count() == 3


def test_sequences_hold_the_ids(documents, reference):
    texts = [f"some words {k} " * (k % 7 * 20) for k in range(40)]
    found = packing.sequences(documents(texts), capacity=64).collect()
    real = sorted(i for r in found for i in r.ids[: r.size])
    assert real == sorted(i for t in texts for i in reference(t))
    assert all(len(r.ids) == 64 or (r.size & (r.size - 1)) == 0 and len(r.ids) == r.size for r in found)


def test_fullest_against_all_subsets():
    draw = random.Random(3)
    for _ in range(200):
        capacity = draw.randint(4, 30)
        counts = {draw.randint(1, capacity): draw.randint(1, 3) for _ in range(draw.randint(1, 5))}
        longest = max(counts)
        most = max(
            sum(n * q for n, q in zip(counts, use))
            for use in itertools.product(*(range(c + 1) for c in counts.values()))
            if use[list(counts).index(longest)] and sum(n * q for n, q in zip(counts, use)) <= capacity
        )
        fill = packing.fullest(counts, capacity)
        assert all(q <= counts[n] for n, q in fill.items()) and longest in fill
        assert sum(n * q for n, q in fill.items()) == most


def test_plan_takes_every_piece_once():
    draw = random.Random(4)
    counts = {draw.randint(1, 1024): draw.randint(1, 10**6) for _ in range(600)}
    table = packing.plan(counts)
    assert len(table["length"]) < 9_000 * 8
    for length, count in counts.items():
        rows = np.flatnonzero(table["length"] == length)
        assert table["rank"][rows[0]] == 0 and (np.diff(table["rank"][rows]) > 0).all() and table["rank"][rows[-1]] < count
