"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over windows, exact edit verification.

The CGK random walk reads a window symbol by symbol; whether it moves on after a step is a coin that depends on the step
and on the symbol. Two windows a few edits apart fall into step again after each edit, so their walks differ in few
places: edit distance becomes Hamming distance. Sampling some places of the walk is a hash that similar windows share, and
repeats with fresh coins reach the recall asked for.

Windows are as long as the item they look for. A document window starts at a word, at a mark, or at a character of three or
more UTF-8 bytes, as Chinese, Japanese and Thai have no blanks; what follows such a character or mark is a start too. The
item is entered at every one of its starts that leaves ``STEPS`` bytes to walk, so a document needs a window at every few
starts only, at different ones in each repeat. The walk is shared by all windows of a batch, symbol by symbol, and a window leaves it as soon as its sampled
places fit no item. What is left is verified: the item's whole text against the document around the window, by exact edit
distance (bit-parallel, any start and end). A document is contaminated by an item if some part of it is within
``edits`` times the item's length.

Texts are lower-cased, and runs of white space are one space, on both sides. Each item has at least ``PROBES`` windows in
each repeat. Items below 81 bytes have few windows: they take more repeats, and those below 40 bytes shorter walks with fewer sampled places. At a tenth
of all characters edited, 0.95 of the passages or more are found (measured in the tests, from 20 characters on);
unedited passages are always found, unless the document runs on into them inside a word and they have no later start.

The items are held by every task, so they are bounded: blocks of at most ``BLOCK_CHARS`` characters, one pass over the
documents for each block.

Defined results: null and empty documents hold nothing; null and empty items are in nothing. Items that occur twice are
found twice. Rows are documents of their own, repeated or null doc_ids too. Empty tables give an empty table.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm import text as tx

EDITS = 0.1
REPEATS = 4
STEPS = 32
SAMPLED = 16
PROBES = 4
BLOCK_CHARS = 32 << 20
SEED = 20_240_229
#: Items shorter than so many bytes have few starts, and so many times the repeats.
SHORT = [(26, 12), (40, 8), (50, 24), (81, 4)]
#: After so many sampled places a window must fit some item or leave.
SIEVES = (3, 6, 9, 12)

FOUND = "doc_id long, item_id long, distance long, start long, end long"
BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: First bytes of characters that make up words: letters and digits of one byte, characters of two bytes but for Latin-1
#: marks. Those of three and four bytes stand for themselves, as their scripts often go without blanks, or are marks.
WORDS = np.array([chr(b).isalnum() if b < 128 else 0xC3 <= b < 0xE0 for b in range(256)])
STEP = np.uint64(0x9E3779B97F4A7C15)


def squeeze(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a lower-cased column with runs of white space as one space, and where each row starts."""
    data, offsets = tx.flat(tx.lower(column.fill_null("")))
    blank = BLANKS[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return np.where(blank, np.uint8(32), data)[keep], kept[offsets]


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a window may start: each character but blanks and those inside a word of letters and digits."""
    if not len(data):
        return np.empty(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    symbol = data[at]
    inside = WORDS[symbol]
    start = symbol != 32
    start[1:] &= ~(inside[1:] & inside[:-1])
    first = np.searchsorted(at, offsets[:-1][offsets[:-1] < len(data)])
    start[first] = symbol[first] != 32
    return at[start]


class Walk:
    """One repeat for items that allow ``steps`` bytes: coins, sampled places, and the item windows by hash."""

    def __init__(self, steps: int, repeat: int):
        draw = np.random.default_rng([SEED, steps, repeat])
        self.coins = draw.integers(0, 2, (steps, 256)).astype(np.int64)
        places = draw.choice(steps, min(SAMPLED, steps) if steps != 16 else 10, replace=False)
        self.places = set(places.tolist())
        self.steps, self.bits = steps, np.uint64(50)
        self.sieves: dict[int, np.ndarray] = {}
        self.keys = np.empty(0, np.uint64)
        self.windows: list[list[tuple[int, int]]] = []

    def hashes(self, data: np.ndarray, at: np.ndarray, sieve: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window that starts at ``at``, and which windows are still there at the end."""
        index, at = np.arange(len(at)), at.copy()
        key = np.zeros(len(at), np.uint64)
        taken = 0
        for step in range(self.steps):
            symbol = data[at]
            if step in self.places:
                key = (key + symbol + np.uint64(1)) * STEP
                key ^= key >> np.uint64(29)
                taken += 1
                if sieve and taken in self.sieves:
                    fits = self.sieves[taken][(key >> self.bits).astype(np.int64)]
                    index, at, key, symbol = index[fits], at[fits], key[fits], symbol[fits]
                    if not len(at):
                        break
            at += self.coins[step][symbol]
        return key, index

    def learn(self, data: np.ndarray, windows: list[tuple[int, int, int]]) -> None:
        """Enter windows (position, item, bytes into the item)."""
        at = np.array([w[0] for w in windows], np.int64)
        size = min(max(len(at).bit_length() + 4, 14), 22)  # bits of a sieve's index: some 16 slots a window
        self.bits = np.uint64(64 - size)
        for taken in SIEVES:
            if taken < len(self.places):
                part = Walk.__new__(Walk)
                part.coins, part.steps, part.sieves = self.coins, 1 + sorted(self.places)[taken - 1], {}
                part.places = set(sorted(self.places)[:taken])
                fits = np.zeros(1 << size, bool)
                fits[(part.hashes(data, at, False)[0] >> self.bits).astype(np.int64)] = True
                self.sieves[taken] = fits
        key, _ = self.hashes(data, at, False)
        self.keys, place = np.unique(key, return_inverse=True)
        self.windows = [[] for _ in self.keys]
        for k, (_, item, into) in zip(place.tolist(), windows):
            self.windows[k].append((item, into))


class Index:
    """Items of one block, ready to be looked for."""

    def __init__(self, items: list[tuple[int | None, str | None]], edits: float = EDITS, repeats: int = REPEATS):
        named = [(k, " ".join(t.lower().split())) for k, t in items if t and t.strip()]
        self.ids = [k for k, _ in named]
        self.texts = [t for _, t in named]
        self.edits, self.repeats = edits, repeats
        self.bytes = [t.encode() for t in self.texts]
        data = np.frombuffer(b"".join(self.bytes) + b"\0" * (STEPS + 1), np.uint8)
        starts = np.cumsum([0, *map(len, self.bytes)])
        groups: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
        for item, raw in enumerate(self.bytes):
            times = next((n for most, n in SHORT if len(raw) < most), 1)
            steps = min(STEPS if len(raw) >= 40 else STEPS // 2, 1 << (len(raw).bit_length() - 1))
            own = word_starts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            own = own[own <= len(raw) - steps]
            stride = 1 << max(0, min(3, int(math.log2(max(1, len(own) // PROBES)))))
            groups.setdefault((steps, times, stride), []).extend((int(starts[item]) + int(o), item, int(o)) for o in own)
        self.walks: list[tuple[int, int, Walk]] = []
        for (steps, times, stride), windows in sorted(groups.items()):
            for repeat in range(repeats * times):
                walk = Walk(steps, repeat)
                walk.learn(data, windows)
                self.walks.append((stride, repeat * stride // (repeats * times), walk))

    def limit(self, item: int) -> int:
        return int(self.edits * len(self.texts[item]))

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int, int]]:
        """(row, item, byte position in data where the item would start) of all windows that share a hash."""
        words = word_starts(data, offsets)
        padded = np.concatenate([data, np.zeros(STEPS + 1, np.uint8)])
        found: set[tuple[int, int, int]] = set()
        for stride, phase, walk in self.walks:
            at = words[phase::stride]
            key, index = walk.hashes(padded, at)
            if not len(key):
                continue
            spot = np.minimum(np.searchsorted(walk.keys, key), len(walk.keys) - 1)
            hit = walk.keys[spot] == key
            positions = at[index[hit]]
            rows = tx.owners(offsets, positions)
            for row, place, windows in zip(rows.tolist(), positions.tolist(), spot[hit].tolist()):
                found.update((row, item, place - into) for item, into in walk.windows[windows])
        return found

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, distance, start, end) of the best place of every item in every row that holds it."""
        data, offsets = squeeze(column)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        tried: set[tuple[int, int, int]] = set()
        for row, item, start in sorted(self.candidates(data, offsets)):
            size, slack = len(self.bytes[item]), 4 * self.limit(item) + 4
            spot = (row, item, start // max(1, slack // 2))
            if spot in tried or best.get((row, item), (1,))[0] == 0:
                continue
            tried.add(spot)
            low = max(int(offsets[row]), start - slack)
            high = min(int(offsets[row + 1]), start + size + slack + slack // 2)
            part = data[low:high].tobytes().decode("utf-8", "ignore")
            found = _place(self.texts[item], part, self.limit(item))
            if found and (row, item) in best and best[row, item][0] <= found[0]:
                continue
            if found:
                shift = len(data[int(offsets[row]) : low].tobytes().decode("utf-8", "ignore"))
                best[row, item] = (found[0], shift + found[1], shift + found[2])
        for (row, item), (distance, start, end) in best.items():
            yield row, item, distance, start, end


def ends(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a part of ``text``, and where the first such part ends."""
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = {}
    for k, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << k
    up, down, score = full, 0, size
    best, end = size, 0
    for k, c in enumerate(text):
        same = where.get(c, 0)
        keep = same | down
        same = (((same & up) + up) ^ up) | same
        plus = down | ~(same | up) & full
        minus = up & same
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | ~(keep | plus) & full
        down = plus & keep
        if score < best:
            best, end = score, k + 1
    return best, end


@functools.lru_cache(maxsize=4096)
def _place(pattern: str, text: str, limit: int) -> tuple[int, int, int] | None:
    """Distance, start and end of the best part of ``text``, if within the limit; copies of a part are looked up."""
    at = text.find(pattern)
    if at >= 0:
        return 0, at, at + len(pattern)
    distance, end = ends(pattern, text)
    if distance > limit:
        return None
    _, back = ends(pattern[::-1], text[:end][::-1])
    return distance, end - back, end


def blocks(benchmark: DataFrame, item_id: str, text: str, most: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items in lists of bounded size."""
    slim = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    total, longest = slim.agg(F.sum(F.length("text")), F.max(F.length("text"))).first()
    if (longest or 0) > most:
        raise ValueError(f"an item of {longest} characters; a block holds {most}")
    parts = math.ceil(2 * (total or 0) / most) or 1
    for part in range(parts):
        mine = slim if parts == 1 else slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = [tuple(r) for r in mine.collect()]
        if rows:
            yield rows


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in tx.pieces(batch, "text"):
                rows = list(index.search(part.column("text")))
                ids = part.column("doc_id").to_pylist()
                columns = [[ids[r[0]] for r in rows], [index.ids[r[1]] for r in rows], *([r[k] for r in rows] for k in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "distance", "start", "end"]
                )

    return run


def find(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", edits: float = EDITS, repeats: int = REPEATS,
) -> DataFrame:
    """One row per document and item in it: doc_id, item_id, distance, start, end (code points, white space squeezed)."""
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    nothing = F.lit(None).cast("long")
    out = slim.where(F.lit(False)).select("doc_id", *(nothing.alias(c) for c in ("item_id", "distance", "start", "end")))
    for items in blocks(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(Index(items, edits, repeats))
        out = out.unionByName(slim.mapInArrow(_search(shared), FOUND))
    return out


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, text: str = "text", edits: float = EDITS, repeats: int = REPEATS) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged; no row moves."""
    place = docs.columns.index(text)
    for items in blocks(benchmark, "item_id", "text"):
        shared = spark.sparkContext.broadcast(Index(items, edits, repeats))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                done = 0
                plain = pa.RecordBatch.from_arrays([batch.column(place)], names=["text"])
                for part in tx.pieces(plain, "text"):
                    clean[[done + r[0] for r in index.search(part.column(0))]] = False
                    done += part.num_rows
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
