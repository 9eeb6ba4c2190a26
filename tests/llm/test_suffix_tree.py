"""Suffix-tree scores against a tree of dictionaries in Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cropledger.llm import suffix_tree
from cropledger.llm.suffix_tree import Shape


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


class Tree:
    def __init__(self, rows, shape):
        self.shape = shape
        self.next = defaultdict(Counter)
        for doc, text in rows:
            if not held(doc):
                words = words_of(text)
                for i, w in enumerate(words):
                    for d in range(min(i, shape.depth) + 1):
                        self.next[tuple(words[i - d : i])][w] += 1
        self.one = self.next[()]
        self.total, self.distinct = sum(self.one.values()), len(self.one)
        self.tested = {}

    def prior(self, w):
        return (self.one[w] + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def retained(self, context):
        if context not in self.tested:
            total = sum(self.next[context].values()) if context in self.next else 0
            good = total >= self.shape.least and (len(context) == 1 or self.retained(context[1:]))
            seen = {w: c for w, c in self.next.get(context, {}).items() if c > 1}
            if good and seen:
                before = {w: 2.0 ** (min(np.rint(-8 * math.log2(self.p(context[1:], w))), 255) / -8) for w in seen}
                gain = sum(c * math.log(c / total / before[w]) for w, c in seen.items())
                rest = total - sum(seen.values())
                if rest:
                    gain += rest * math.log(rest / total / max(1 - sum(before.values()), 1e-9))
                good = gain > self.shape.nats * len(seen)
            self.tested[context] = (good and bool(seen)) and (total, seen)
        return self.tested[context]

    def p(self, context, w):
        """In the longest retained suffix of a context."""
        here = self.prior(w)
        for d in range(1, len(context) + 1):
            state = self.retained(context[len(context) - d :])
            if not state:
                break
            total, seen = state
            delta = self.shape.discount
            left = (total - sum(seen.values()) + delta * len(seen)) / total
            here = (seen[w] - delta if w in seen else 0) / total + left * here
        return here

    def score(self, words):
        return sum(math.log10(self.p(tuple(words[max(0, i - self.shape.depth) : i]), w)) for i, w in enumerate(words))


def check(docs, rows, shape=Shape()):
    tree = Tree(rows, shape)
    wanted = []
    for doc, text in rows:
        words = words_of(text)
        base = sum(math.log10(tree.prior(w)) for w in words)
        wanted.append((doc, held(doc), len(words), sum(tree.one[w] > 0 for w in words), tree.total, base, tree.score(words)))
    got = [tuple(r) for r in suffix_tree.score(docs, shape=shape).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    assert len(got) == len(wanted)
    for a, b in zip(sorted(got, key=key), sorted(wanted, key=key)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    return tree


def corpus(seed, documents=80):
    rng = random.Random(seed)
    vocabulary = [f"{'Xy'[k % 2]}{k}" for k in range(40)]
    follow = {w: rng.choices(vocabulary, k=4) for w in vocabulary}
    rows = []
    for k in range(documents):
        words = [rng.choice(vocabulary)]
        while len(words) < rng.randrange(5, 80):
            pair = sum(map(ord, "".join(words[-2:]))) % 3
            words.append(follow[words[-1]][pair] if rng.random() < 0.8 and words[-1] in follow else rng.choice([*vocabulary, f"rare{rng.randrange(999)}"]))
        rows.append((k, rng.choice([" ", "\n", "\t \r"]).join(words)))
    return rows


@pytest.mark.parametrize("depth", [0, 1, 2, 3])
def test_scores_of_every_depth(documents, depth):
    rows = corpus(depth)
    tree = check(documents(rows).repartition(3), rows, Shape(depth, 4, 1.0, 0.7))
    kept = Counter(len(c) for c, state in tree.tested.items() if state)
    # The words depend on two before them, so that a third is hardly ever retained.
    assert set(kept) >= set(range(1, min(depth, 2) + 1)) and all(kept[d] > 4 for d in range(1, min(depth, 2) + 1))
    assert not depth or sum(1 for state in tree.tested.values() if not state) > 4


def test_many_parts_and_contexts_above_their_share(documents, monkeypatch):
    """A third of all words is one word, whose successors are spread over parts."""
    monkeypatch.setattr(suffix_tree, "PART", 50)
    rng = random.Random(9)
    rows = [(k, " ".join(f"hot w{rng.randrange(12)} v{rng.randrange(3)}" for _ in range(40))) for k in range(40)]
    check(documents(rows).repartition(5), rows, Shape(2, 3, 0.5, 0.8))


def test_nulls_repeated_rows_and_long_texts(documents):
    long = "the same line again\n" * 20_000
    rows = [
        (1, None), (2, ""), (3, "   "), (None, "a b a b"), (4, "A B a b"), (4, "A B a b"), (5, long), (6, long[:50_000]), (7, "é É   x"),
        (8, "x" * 5000), (9, "x" * 5000),
    ]
    check(documents(rows), rows)


def test_without_training_documents(documents):
    doc = next(k for k in range(99) if held(k))
    (row,) = suffix_tree.score(documents([(doc, "some words")])).collect()
    assert tuple(row) == (doc, True, 3, 0, 0, 0.0, 0.0)


def test_empty_table_and_clashing_columns(spark, documents):
    assert suffix_tree.score(documents([])).count() == 0
    rows = [(k, "a b c a b c") for k in range(10)]
    df = spark.createDataFrame([(*r, "x", 2.0) for r in rows], "doc_id long, text string, block string, score double")
    check(df, rows)


def test_probabilities_sum_to_one():
    """Over all words and one unknown: in the tree that the scores are held to."""
    tree = Tree(corpus(3), Shape(2, 4, 1.0, 0.7))
    contexts = [c for c in list(tree.next) if len(c) < 2 or tree.retained(c)]
    assert len(contexts) > 40
    for context in contexts:
        assert sum(tree.p(context, w) for w in [*tree.one, "unknown"]) == pytest.approx(1.0)


def test_held_out_text_is_likelier_than_by_single_words(real):
    found = suffix_tree.score(real("documents")).where("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
