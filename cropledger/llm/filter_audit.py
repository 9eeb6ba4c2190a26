"""How five document filters overlap, and what each order of them costs.

Four filters look at one text: A under 200 words, B distinct words below half of all, C capitals above 2 % of the code points,
D one of the marks ``#$%&*|``. E fails a document whose text a smaller doc_id has too, wherever in the table. Each document
becomes one bit mask of the filters it fails, and all 120 orders are read off additive counts by part and mask.

E needs equal texts to meet, and most texts have no equal. A counting Bloom sketch goes before: each task counts its texts into
cells, saturated at two, partial sketches are merged by slice, and a text one of whose cells was hit once is alone for
certain. Only texts all of whose cells were hit twice shuffle, and are grouped by their full content for the smallest id. The
sketch has eight cells a row, cut into slices, so it grows with the table and no task, broadcast or driver holds it whole.

The keys of possible repeats are broadcast up to ``MOST_KEYS`` of them, counted before; beyond that Spark joins by key, so
that texts move before they are cleared. Results do not depend on it.

Defined results: a null text is empty, a null part is an empty string. A null doc_id ranks behind all others, so it
fails E if an equal text has an id; rows equal in text and smallest id all pass E. Documents without a label lose neither good
nor toxic ones; of several labels of one id the highest counts. An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.llm import text as tx
from cropledger.operators.lookup import join_null_safe
from cropledger.session import WorkFolder

FILTERS = "ABCDE"
#: Fixed thresholds of the filters.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
REPEATED = 1 << FILTERS.index("E")

#: Cells for each row, cells of a slice at most, cells of one text, and texts that a task counts before it hands out a sketch.
CELLS_PER_ROW, SLICE_CELLS, HASHES, FLUSH = 8, 1 << 23, 3, 1 << 20
#: Keys of possible repeats (8 bytes each) that may be broadcast.
MOST_KEYS = 4_000_000

FLAGS = "doc_id long, part string, mask int, digest binary, key long"


def failing(text: str) -> int:
    """Mask of the filters A to D that a text fails."""
    data = text.encode()
    words = data.split()  # of bytes: at 0x20 and 0x09 to 0x0D
    capitals = len(data) - len(data.translate(None, CAPITALS))
    broken = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * capitals > CAPITAL_PERCENT * len(text),
        len(data.translate(None, MARKS)) < len(data),
    )
    return sum(bad << k for k, bad in enumerate(broken))


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mask = pa.array([failing(t) for t in batch.column("text").to_pylist()], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), mask, batch.column("digest"), batch.column("key")],
            names=["doc_id", "part", "mask", "digest", "key"],
        )


def _cells(keys: np.ndarray, slices: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Slice of each key, and its cells there."""
    h = tx.mix(keys.view(np.uint64))
    place = [tx.mix(h + np.uint64(k + 1)) & np.uint64(cells - 1) for k in range(HASHES)]
    return (h >> np.uint64(32)) % np.uint64(slices), np.stack(place).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The keys of a task, in pieces of about FLUSH."""
    held, n = [], 0
    for batch in batches:
        held.append(batch.column("key").to_numpy(zero_copy_only=False))
        n += batch.num_rows
        if n >= FLUSH:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _by_slice(which: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(which, kind="stable")
    first = np.flatnonzero(np.diff(which[order], prepend=np.uint64(1 << 62)))
    for a, b in zip(first, [*first[1:], len(order)]):
        yield int(which[order[a]]), order[a:b]


def _counted(slices: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys in _gathered(batches):
            which, place = _cells(keys, slices, cells)
            rows = []
            for at, own in _by_slice(which):
                cell, hits = np.unique(place[:, own], return_counts=True)
                cell = cell.astype("<u4")
                rows.append({"slice": at, "once": cell[hits == 1].tobytes(), "more": cell[hits > 1].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("slice", pa.int64()), ("once", pa.binary()), ("more", pa.binary())]))

    return run


def _merged(cells: int):
    def run(key: tuple, partial: pa.Table) -> pa.Table:
        hits = np.zeros(cells, np.uint8)
        for once, more in zip(partial.column("once"), partial.column("more")):
            place = np.frombuffer(once.as_buffer(), "<u4")
            hits[place] = np.minimum(hits[place] + 1, 2)
            hits[np.frombuffer(more.as_buffer(), "<u4")] = 2
        return pa.table({"slice": [key[0].as_py()], "twice": [np.packbits(hits > 1).tobytes()]})

    return run


def _asked(slices: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys in _gathered(batches):
            keys = np.unique(keys)
            which, _ = _cells(keys, slices, cells)
            rows = [{"slice": at, "keys": keys[own].tobytes()} for at, own in _by_slice(which)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("slice", pa.int64()), ("keys", pa.binary())]))

    return run


def _uncleared(slices: int, cells: int):
    def run(key: tuple, asked: pa.Table, sketch: pa.Table) -> pa.Table:
        twice = np.unpackbits(np.frombuffer(sketch.column("twice")[0].as_buffer(), np.uint8)).view(bool)
        out = []
        for row in asked.column("keys"):
            keys = np.frombuffer(row.as_buffer(), np.int64)
            out.append(keys[twice[_cells(keys, slices, cells)[1]].all(0)])
        return pa.table({"key": np.unique(np.concatenate(out))})

    return run


def possible_repeats(keyed: DataFrame, rows: int) -> DataFrame:
    """Distinct ``key`` values of a table of so many rows that the merged sketch does not clear as single ones."""
    wanted = max(rows, 1) * CELLS_PER_ROW
    cells = min(SLICE_CELLS, 1 << max(wanted - 1, 63).bit_length())
    slices = -(-wanted // cells)
    keys = keyed.select("key")
    partial = keys.mapInArrow(_counted(slices, cells), "slice long, once binary, more binary")
    sketch = partial.groupBy("slice").applyInArrow(_merged(cells), "slice long, twice binary")
    asked = keys.mapInArrow(_asked(slices, cells), "slice long, keys binary")
    return asked.groupBy("slice").cogroup(sketch.groupBy("slice")).applyInArrow(_uncleared(slices, cells), "key long")


def masks(docs: DataFrame, work: WorkFolder, *, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part and mask of every row, all five filters in the mask."""
    content = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        content.alias("text"),
    )
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    keyed = slim.select("doc_id", "part", "text", digest, F.xxhash64("text").alias("key"))
    flags = work.keep("flags", keyed.mapInArrow(_flags, FLAGS))
    rows = flags.count()
    repeats = work.keep("repeats", possible_repeats(flags, rows))
    repeats = F.broadcast(repeats) if repeats.count() <= MOST_KEYS else repeats.hint("merge")

    # Only what the sketch did not clear gets here. The grouping holds whole texts against each other.
    possible = slim.select("doc_id", "text", F.xxhash64("text").alias("key")).join(repeats, "key", "left_semi")
    firsts = possible.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", digest)
    firsts = work.keep("firsts", firsts)
    # Keyed by doc_id too, so that a text of many rows is no hot key.
    others = join_null_safe(possible.select("doc_id", digest), firsts, ["doc_id", "digest"], "left_anti")
    others = others.distinct().withColumn("repeated", F.lit(REPEATED))
    marked = join_null_safe(flags.drop("key"), others, ["doc_id", "digest"])
    return marked.select("doc_id", "part", (F.col("mask") + F.coalesce("repeated", F.lit(0))).alias("mask"))


def counts(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask: all, those labelled good, those labelled toxic."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    return (
        marked.join(known, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )


def orders(counted: DataFrame) -> DataFrame:
    """What each step of each order keeps and removes: 600 rows a part."""
    every = range(1 << len(FILTERS))
    permutations = ["".join(p) for p in itertools.permutations(FILTERS)]

    def passing(what: str) -> Column:
        """Documents that fail none of the filters in a set, for each of the 32 sets."""
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) == 0, F.col(what)).otherwise(0)) for s in every])

    def fails(k: int) -> Column:
        return F.col("mask").bitwiseAND(F.lit(1 << k)) != 0

    letters = range(len(FILTERS))
    # Of the filters a document fails, each comes first in as many orders.
    share = F.col("n") * (F.lit(len(permutations)) / F.bit_count("mask")).cast("long")
    by_part = counted.groupBy("part").agg(
        passing("n").alias("kept"), passing("good").alias("good"), passing("toxic").alias("toxic"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in letters]).alias("only"),
        F.array(*[F.sum(F.when(fails(k), share).otherwise(0)) for k in letters]).alias("first"),
    )
    steps = by_part.withColumn("filter_order", F.explode(F.split(F.lit(" ".join(permutations)), " "))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )
    steps = steps.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    place = F.instr(F.lit(FILTERS), F.col("filter"))
    before = sum(
        (F.when(F.instr("filter_order", FILTERS[k]) < F.col("step"), 1 << k).otherwise(0) for k in letters), F.lit(0)
    )
    bit = F.pow(F.lit(2), place - 1).cast("int")
    steps = steps.withColumns({"place": place, "before": before, "bit": bit})
    after = F.col("before") + F.col("bit")

    def at(sums: str, chosen: Column) -> Column:
        return F.element_at(sums, (chosen + 1).cast("int"))

    removed = at("kept", F.col("before")) - at("kept", after)
    all_failing = at("kept", F.lit(0)) - at("kept", F.col("bit"))
    return steps.select(
        "part", "filter_order", "step", at("kept", after).alias("kept"), removed.alias("removed"),
        (all_failing - removed).alias("redundant"), F.element_at("only", F.col("place")).alias("unique_fails"),
        (at("good", F.col("before")) - at("good", after)).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", after)).alias("toxic_lost"),
        F.element_at("first", F.col("place")).alias("shapley"), "filter",
    )


def audit(docs: DataFrame, labels: DataFrame, *, part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step, with what the step keeps and removes."""
    work = WorkFolder(docs.sparkSession)
    counted = work.keep("counts", counts(masks(docs, work, part=part), labels))
    work.drop("flags", "repeats", "firsts")
    return orders(counted)
