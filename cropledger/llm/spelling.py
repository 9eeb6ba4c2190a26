"""Spelling variants: words one code point apart, and the form each word most likely stands for.

Near words are found in a bit-sliced position index. For every (position, letter) it holds a bitset over the indexed words; a
word w is run against it letter by letter, for all indexed words at once, 64 in a machine word. Three sets are kept: words
that agree so far, words with one letter replaced so far, and words with one letter more so far, for which positions
are shifted by one. What is left in the sets at the end are the words one replacement, or one insertion, away from w. A deletion is
an insertion seen from the longer word. Distance 1 is decided by the bits alone; nothing is verified afterwards.

The vocabulary grows with the corpus, so the index is cut. Of two words one edit apart, the shorter of length m, either the first
m // 2 letters agree or the last m - m // 2 do. Words are therefore dealt by length and half into slices of about ``SLICE``
words, and only words of a slice are run against it: work in proportion to the vocabulary. A half that many words share would make a
large slice; it is cut into blocks, and every block of words is run against every block of the index. No half is left out.

Words here are runs of letters from A to Z, a to z, U+00C0 to U+00FF, so a letter is one byte of Latin-1.

Defined results: a null text has no words; a null doc_id counts as empty in the checksum. Repeated rows count each. A run of
any length is a word. Of near words with equal n the smallest in code-point order is the form. An empty table gives an
empty table. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cropledger.session import WorkFolder

#: Fixed values of the contract: letters of a run, one occurrence in so many is damaged.
RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
DAMAGED = 97

LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A word's form has at least so many times its count.
DOMINANCE = 2
#: Distinct words a task holds before it hands out their counts.
FLUSH = 1 << 19
#: Indexed words of a slice; long words count by their letters.
SLICE, SLICE_LETTERS = 4096, 1 << 22
#: Bytes of one set of a block of words against the index: what stays in the cache.
BLOCK_BYTES = 1 << 18
#: Lengths from here on share the count by which their slices are sized.
LONG = 64

GROUP = ["half", "m", "slice", "index_block", "word_block"]
INDEXED, RUN_AGAINST = 1, 2


def damaged(doc_id: int | None, text: str, least: int = LEAST_LETTERS) -> Counter:
    """Words of a document of at least so many letters, some of them damaged as the contract says."""
    low = text.encode().translate(LOWER).decode()
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for word, n in Counter(RUN.findall(low)).items():
        h = zlib.crc32(word.encode(), before)
        if h % DAMAGED == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1 :]
        if len(word) >= least:
            out[word] += n
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    held: Counter = Counter()
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            if text.is_valid:
                held.update(damaged(doc, text.as_py()))
            if len(held) >= FLUSH:
                yield rows()
                held.clear()
    if held:
        yield rows()


def vocabulary(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """word, n of every word with at least so many occurrences."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = slim.mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _dealt(words: DataFrame, work: WorkFolder) -> DataFrame:
    """Words with the slices and blocks they are indexed in or run against, and their role there."""
    size = F.length("word")
    lengths = {r["size"]: r["n"] for r in words.groupBy(F.least(size, F.lit(LONG)).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def slices_of(m: int) -> int:
        # Words of length m and m + 1 are indexed for class m.
        held = lengths.get(m, 0) + lengths.get(m + 1, 0)
        return -(-held // max(1, min(SLICE, SLICE_LETTERS // m)))

    number = F.lit(1)
    for m in range(1, LONG + 1):
        if slices_of(m) > 1:
            number = F.when(F.least(F.col("m"), F.lit(LONG)) == m, slices_of(m)).otherwise(number)

    def entry(half: str, longer: int, role: int) -> Column:
        return F.struct(F.lit(half).alias("half"), (size - longer).alias("m"), F.lit(role).alias("role"))

    every = F.array(*[entry(h, 0, INDEXED | RUN_AGAINST) for h in "<>"], *[entry(h, 1, INDEXED) for h in "<>"])
    # Below the shortest word there is nothing to run against an index.
    rows = words.select("word", "n", F.inline(every)).where(F.col("m") >= min(lengths, default=1))
    first = F.floor(F.col("m") / 2).cast("int")
    key = F.when(F.col("half") == "<", F.left("word", first)).otherwise(F.right("word", F.col("m") - first))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64(key), number))

    most = F.greatest(F.lit(1), F.least(F.lit(SLICE), F.lit(SLICE_LETTERS) / F.col("m")))
    blocks = F.ceil(F.count(F.lit(1)) / F.max(most)).cast("int")
    crowded = rows.groupBy("half", "m", "slice").agg(blocks.alias("blocks")).where("blocks > 2")
    crowded = work.keep("crowded", crowded)
    rows = rows.join(crowded, ["half", "m", "slice"], "left")
    whole = F.array(F.struct(F.lit(0).alias("index_block"), F.lit(0).alias("word_block"), F.col("role").alias("as")))
    own = F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    indexed = F.transform(others, lambda b: F.struct(own.alias("index_block"), b.alias("word_block"), F.lit(INDEXED).alias("as")))
    against = F.transform(others, lambda b: F.struct(b.alias("index_block"), own.alias("word_block"), F.lit(RUN_AGAINST).alias("as")))
    cut = F.when(F.col("role") == INDEXED, indexed).otherwise(F.concat(indexed, against))
    places = F.when(F.col("blocks").isNull(), whole).otherwise(cut)
    return rows.select("half", "m", "slice", "word", "n", F.inline(places))


def _bits(rows: np.ndarray) -> np.ndarray:
    """Boolean rows as bitsets of 64-bit words, bit j of word i for element 64 i + j."""
    packed = np.packbits(rows, axis=1, bitorder="little")
    wide = np.zeros((len(rows), -(-rows.shape[1] // 64) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view("<u8")


def _ones(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and element of every bit set."""
    row, at = np.nonzero(sets)
    bits = np.unpackbits(sets[row, at].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    k, bit = np.nonzero(bits)
    return row[k], at[k] * 64 + bit


def _sliced(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position of the index: for each byte the row of its bitset (the last row is empty), and the bitsets."""
    seen, of = np.unique(letters, return_inverse=True)
    held = np.zeros((len(seen) + 1, len(letters)), bool)
    held[of, np.arange(len(letters))] = True
    row = np.full(256, len(seen))
    row[seen] = np.arange(len(seen))
    row[0] = len(seen)  # beyond the end of a word
    return row, _bits(held)


def one_apart(index: np.ndarray, words: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, indexed) pairs exactly one replacement or insertion apart.

    Both are arrays of m + 1 bytes a word, zero beyond its end; ``words`` have m letters, ``index`` m or m + 1.
    """
    if not len(index) or not len(words):
        return np.empty(0, int), np.empty(0, int)
    longer = index[:, m] != 0
    same_length, one_more = _bits(~longer[None])[0], _bits(longer[None])[0]
    step = max(1, BLOCK_BYTES // (8 * len(same_length)))
    found = []
    for at in range(0, len(words), step):
        own = words[at : at + step]
        exact = np.broadcast_to(same_length | one_more, (len(own), len(same_length))).copy()
        replaced, inserted = np.zeros_like(exact), exact & one_more
        row, sets = _sliced(index[:, 0])
        for i in range(m):
            here = sets[row[own[:, i]]]
            row, sets = _sliced(index[:, i + 1])
            shifted = sets[row[own[:, i]]]
            replaced &= here
            replaced |= exact & ~here
            exact &= here
            inserted &= shifted
            inserted |= exact
        word, other = _ones((replaced & same_length) | (inserted & one_more))
        found.append((word + at, other))
    return tuple(np.concatenate(x) for x in zip(*found))


def _near(key: tuple, group: pa.Table) -> pa.Table:
    """Of each word of a block: its near words there, and the best of them."""
    half, m = key[0].as_py(), key[1].as_py()
    names, counts = np.array(group.column("word").to_pylist(), object), group.column("n").to_numpy()
    role = group.column("as").to_numpy()
    latin = np.array([w.encode("latin-1") for w in names.tolist()], f"S{m + 1}")
    spelled = latin.view(np.uint8).reshape(len(names), m + 1)
    indexed, own = np.flatnonzero(role & INDEXED), np.flatnonzero(role & RUN_AGAINST)
    word, other = one_apart(spelled[indexed], spelled[own], m)
    word, other = own[word], indexed[other]
    # A pair is counted where the first half agrees, and by the second half only where the first does not.
    first = m // 2
    front = (spelled[word, :first] == spelled[other, :first]).all(1)
    if half == "<":
        counted = front
    else:
        # The longer of two words ends one place later.
        longer = spelled[other, m] != 0
        ends = np.where(longer[:, None], spelled[other, first + 1 :], spelled[other, first:m])
        counted = ~front & (spelled[word, first:m] == ends).all(1)
    word, other = word[counted], other[counted]
    # Words of one length meet from both sides; a longer word is never run against a shorter one.
    longer = spelled[other, m] != 0
    word, other = np.concatenate([word, other[longer]]), np.concatenate([other, word[longer]])
    rank = np.empty(len(names), np.int64)
    rank[np.lexsort((latin, -counts))] = np.arange(len(names))
    order = np.lexsort((rank[other], word))
    word, other = word[order], other[order]
    start = np.flatnonzero(np.diff(word, prepend=-1))
    return pa.table({
        "word": pa.array(names[word[start]].tolist(), pa.string()),
        "n_near": np.diff(start, append=len(word)).astype(np.int64),
        "best_n": counts[other[start]].astype(np.int64),
        "best": pa.array(names[other[start]].tolist(), pa.string()),
    })


def near_words(words: DataFrame, work: WorkFolder) -> DataFrame:
    """word, n_near, best_n, best of every word that has a near one; ``words`` holds distinct words with their n."""
    dealt = _dealt(words, work)
    found = dealt.groupBy(*GROUP).applyInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("low"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.low")).alias("best_n"), F.col("top.word").alias("best")
    )


def _roots(formed: DataFrame, work: WorkFolder) -> DataFrame:
    """The end of each word's chain of forms. Counts grow along a chain, so there is no circle; each round doubles the reach."""
    reached = work.keep("reach0", formed.select("word", F.col("form").alias("root")))
    turn, moving = 0, True
    while moving:
        turn += 1
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.join(further.hint("merge"), "root", "left")
        moved = Observation()
        seen = joined.observe(moved, F.count("next").alias("n"))
        reached = work.keep(f"reach{turn}", seen.select("word", F.coalesce("next", "root").alias("root")))
        work.drop(f"reach{turn - 1}")
        moving = moved.get["n"] > 0
    return reached


def variants(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n of the whole vocabulary."""
    work = WorkFolder(docs.sparkSession)
    words = work.keep("words", vocabulary(docs, doc_id=doc_id, text=text, least=least))
    near = work.keep("near", near_words(words, work))
    wins = F.col("best_n") >= DOMINANCE * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", F.when(wins, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(wins, F.col("best_n")).alias("form_n"),
    )
    formed = work.keep("formed", formed)
    roots = _roots(formed.where(F.col("form").isNotNull()), work)
    work.drop("words", "near", "crowded")
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
