"""Near duplicates: DartMinHash signatures of weighted word shingles, banded joining, exact verification, classes.

A document is a set of five-word shingles, weighted by how often they occur. Each shingle owns a region: its weight high,
its rank axis open-ended. Darts fall on it as a Poisson process of unit density whose positions are hashes of the shingle,
so every document that has the shingle sees the same darts up to its own weight. Only darts of rank below
k (ln k + 2) / total weight are thrown: about that many for a document of any length. Each dart has a coordinate of k;
the earliest dart of a coordinate is the signature there, and two documents agree in one with the probability of their
weighted Jaccard similarity. A coordinate left empty doubles the rank and throws again.

Signatures are cut into bands; texts that agree in a whole band share a bucket. With 20 bands of 5 a pair of similarity
0.8 shares none in 0.04 % of cases. Candidates are then verified on the whole shingle sets, in two rounds that never list
the pairs of a group of copies:

1. texts with the same words are one node; each node is held against the hubs of its buckets, the nodes most like the others;
2. of buckets that still hold more than one component, everyone is held against everyone of another component: in blocks
   inside the tasks, which hand out links that join components, not pairs.

A pair is left out before that only if it cannot be similar enough: two sets share at most what remains of each without the
shingles that no other candidate has. A copy with many words of its own is so told from its group by two numbers.

Components are grown by stars between written tables. Nothing of this passes through the driver but one row of checksums.

Defined results: words are lower-cased runs of letters and digits; a text of fewer than five words is one shingle. A text
without words (null or empty too) is a class of its own row. class_id is the smallest doc_id of the class; a null doc_id
takes part and is never the class_id unless the class has no other. Rows that repeat a doc_id are rows of their own. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cropledger.llm import text as tx
from cropledger.session import WorkFolder

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
ROW_LIMIT = 2_000
#: Members of a bucket in one block, and shared items in one step, of the last round.
BLOCK, COLUMNS = 250, 4096
LEVEL = 3

STEPS = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xB564EF22EC7AECE5], np.uint64)
CELL, DART, MARK, HEIGHT = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))
SKETCH = "doc_id long, node binary, keys array<long>, content binary"


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a lower-cased column: distinct shingles, the row of each, how often it occurs; and a digest of each row's words."""
    data, offsets = tx.flat(column)
    start, length = tx.runs(data, offsets, tx.WORDS_ONLY)
    word, row = tx.hashes(data, start, length), tx.owners(offsets, start)
    n = np.bincount(row, minlength=len(column)) if len(row) else np.zeros(len(column), np.int64)
    first = np.cumsum(n) - n
    place = np.arange(len(word)) - first[row]
    begin = np.flatnonzero((place <= n[row] - WORDS) | (place == 0))
    value = np.zeros(len(begin), np.uint64)
    for j in range(WORDS):
        inside = place[begin] + j < n[row[begin]]
        value[inside] += word[begin[inside] + j] * STEPS[j]
    value, of = tx.mix(value), row[begin]
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.flatnonzero((np.diff(value, prepend=np.uint64(0)) != 0) | (np.diff(of, prepend=-1) != 0))
    times = np.diff(np.append(new, len(value)))
    raw = word.tobytes()
    digests = np.array(
        [hashlib.blake2b(raw[8 * a : 8 * (a + m)], digest_size=16).digest() if m else None for a, m in zip(first.tolist(), n.tolist())],
        object,
    )
    return value[new], of[new], times, digests


def signatures(element: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, k: int) -> np.ndarray:
    """Earliest dart of each of k coordinates for every row, as 32-bit marks; weights are positive numbers."""
    out = np.zeros((rows, k), np.uint32)
    total = np.bincount(row, weight, rows) if len(row) else np.zeros(rows)
    rank = np.divide(k * (math.log(k) + 2), total, out=np.zeros(rows), where=total > 0)
    left = total > 0
    while left.any():
        mine = left[row]
        cells = np.ceil(weight[mine]).astype(np.int64)  # a region is cut into cells of height one
        nth = np.arange(int(cells.sum())) - np.repeat(np.cumsum(cells) - cells, cells)
        cell = tx.mix(np.repeat(element[mine], cells) + (nth.astype(np.uint64) + np.uint64(1)) * CELL)
        of = np.repeat(row[mine], cells)
        high = np.minimum(np.repeat(weight[mine], cells) - nth, 1.0)
        at = np.zeros(len(cell))
        flats, ranks, marks = [], [], []
        turn = 0
        while len(cell):  # the next dart of every cell, until it lies beyond the rank
            turn += 1
            dart = tx.mix(cell + np.uint64(turn * int(DART) % 2**64))
            at = at - np.log(tx.unit(dart))
            alive = at < rank[of]
            cell, of, at, high, dart = cell[alive], of[alive], at[alive], high[alive], dart[alive]
            mark = tx.mix(dart + MARK)
            hit = slice(None) if (high >= 1.0).all() else tx.unit(tx.mix(dart + HEIGHT)) < high
            flats.append(of[hit] * k + ((mark[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64))
            ranks.append(at[hit])
            marks.append((mark[hit] >> np.uint64(32)).astype(np.uint32))
        flat, ranked, mark = np.concatenate(flats), np.concatenate(ranks), np.concatenate(marks)
        best = np.full(rows * k, np.inf)
        np.minimum.at(best, flat, ranked)
        earliest = ranked == best[flat]
        found = np.zeros(rows * k, np.uint32)
        found[flat[earliest]] = mark[earliest]
        full = left & np.isfinite(best.reshape(rows, k)).all(axis=1)
        out[full] = found.reshape(rows, k)[full]
        left &= ~full
        rank[left] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, width: int) -> np.ndarray:
    """One bucket key per row and band."""
    parts = signature.reshape(len(signature), bands, width).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * CELL, parts.shape[:2]).copy()
    for j in range(width):
        key = tx.mix(key ^ (parts[:, :, j] + np.uint64(1)))
    return key.view(np.int64)


def _sketch(bands: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            known: set[bytes] = set()  # of this batch: copies carry their node and nothing else
            for part in tx.pieces(batch, "text", rows=ROW_LIMIT):
                low = tx.lower(part.column("text").fill_null(""))
                value, of, times, digests = shingles(low)
                keys = band_keys(signatures(value, of, times.astype(np.float64), part.num_rows, bands * width), bands, width)
                held: list = []
                for k, node in enumerate(digests):
                    fresh = node is not None and node not in known
                    known.add(node)
                    held.append(pack(low[k].as_buffer()) if fresh else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(list(digests), pa.binary()),
                        pa.array([r if h is not None else None for r, h in zip(list(keys), held)], pa.list_(pa.int64())),
                        pa.array(held, pa.binary()),
                    ],
                    names=["doc_id", "node", "keys", "content"],
                )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole shingle sets from texts: the n-th occurrence of a shingle is an element of its own."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_LIMIT // 4):
            part = batch.slice(at, ROW_LIMIT // 4)
            texts = pa.array([unpack(x.as_buffer()).decode("utf-8") for x in part.column("content")], pa.large_string())
            value, of, times, _ = shingles(texts)
            nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            element = tx.mix(np.repeat(value, times) + nth.astype(np.uint64) * CELL).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, times, part.num_rows).astype(np.int64))])
            items = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(element)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("id"), items], names=["id", "items"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of pairs (a, b), those whose whole sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= F.lit(similarity) * (F.size("x") + F.size("y") - shared)).select("a", "b")


def components(edges: DataFrame, work: WorkFolder, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it is connected with.

    Alternating stars: every node hands its larger neighbours to its smallest one, then its smaller ones, until no edge
    changes. Each round is a written table; the one before it is dropped.
    """

    def keep(step: str, table: DataFrame) -> tuple[DataFrame, tuple]:
        """The written table, and a checksum of it taken while it is written."""
        seen = Observation()
        total = F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)")).alias("total")
        path = f"{work.path}/{name}{step}"
        table.observe(seen, F.count(F.lit(1)).alias("n"), total).write.parquet(path)
        return table.sparkSession.read.schema(table.schema).parquet(path), (seen.get["n"], seen.get["total"])

    now, before = keep("0", edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    turn = 0
    while True:
        turn += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least, _ = keep(f"{turn}-large", both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large, _ = keep(f"{turn}-star", large)
        least, _ = keep(f"{turn}-small", large.groupBy("a").agg(F.min("b").alias("m")))
        handed = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        following, found = keep(f"{turn}", handed.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        work.drop(*(f"{name}{step}" for step in (turn - 1, f"{turn}-large", f"{turn}-star", f"{turn}-small")))
        now = following
        if found == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = found


def weights(sets: DataFrame) -> DataFrame:
    """id, size of the set, and how much of it some other set has too."""
    alone = sets.select("id", F.explode("items").alias("item")).groupBy("item").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    alone = alone.where("n = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    sized = sets.select("id", F.size("items").alias("size")).join(alone, "id", "left")
    return sized.select("id", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("rest"))


def _possible(similarity: float) -> Column:
    """Can two sets be similar enough? They share at most what is left of each without the items no other set has."""
    most = F.least("rest", "other_rest")
    return most >= F.lit(similarity) * (F.col("size") + F.col("other_size") - most)


def _linked(similarity: float):
    """Of the sets of one group, links between different roots: enough to join what is similar, not every pair."""

    def run(table: pa.Table) -> pa.Table:
        ids, roots = table["id"].to_pylist(), table["root"].to_pylist()
        items = table["items"].combine_chunks()
        size = np.diff(items.offsets.to_numpy()).astype(np.int64)
        row = np.repeat(np.arange(len(ids)), size)
        _, code, times = np.unique(items.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        held = times[code] > 1
        column = (np.cumsum(times > 1) - 1)[code[held]]
        row, order = row[held], np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        shared = np.zeros((len(ids), len(ids)), np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            low, high = np.searchsorted(column, [at, at + COLUMNS])
            has = np.zeros((len(ids), COLUMNS), np.float32)
            has[row[low:high], column[low:high] - at] = 1
            shared += has @ has.T
        near = shared >= similarity * (np.add.outer(size, size) - shared) - 1e-3
        top = {r: r for r in roots}

        def find(r: int) -> int:
            while top[r] != r:
                top[r] = top[top[r]]
                r = top[r]
            return r

        found = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1)))):
            a, b = find(roots[i]), find(roots[j])
            # in whole numbers, as the pairs of the other rounds are held against each other
            if a != b and shared[i, j] >= similarity * float(size[i] + size[j] - int(shared[i, j])):
                top[a] = b
                found.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _across(there: DataFrame, sets: DataFrame, similarity: float, work: WorkFolder) -> DataFrame:
    """Links between members (bucket, id, root) of the same bucket and different roots.

    A bucket's members of its most frequent root (d) need not meet each other: blocks of the others (o) meet each other
    and the blocks of d. What a task holds is two blocks.
    """
    roots = there.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    plan = roots.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"))
    blocks = lambda n: F.greatest(F.ceil(n / F.lit(BLOCK)), F.lit(1)).cast("int")
    plan = work.keep(
        "plan", count=False,
        df=plan.select("bucket", F.col("most.root").alias("d"), blocks(F.col("most.n")).alias("ds"), blocks(F.col("all") - F.col("most.n")).alias("os")),
    )
    rows = there.select("bucket", "id", "root").join(plan, "bucket").withColumn("hash", F.xxhash64("id", "bucket"))
    mine = F.pmod("hash", F.when(F.col("root") == F.col("d"), F.col("ds")).otherwise(F.col("os"))).cast("int")

    def group(kind: str, i: Column, j: Column) -> Column:
        return F.concat_ws(":", F.lit(kind), F.col("bucket").cast("string"), i.cast("string"), j.cast("string"))

    others, most = F.sequence(F.lit(0), F.col("os") - 1), F.sequence(F.lit(0), F.col("ds") - 1)
    as_most = F.transform(others, lambda i: group("d", i, F.col("mine")))
    as_other = F.concat(
        F.transform(others, lambda j: group("o", F.least(F.col("mine"), j), F.greatest(F.col("mine"), j))),
        F.transform(most, lambda j: group("d", F.col("mine"), j)),
    )
    dealt = rows.withColumn("mine", mine).select("id", "root", F.explode(F.when(F.col("root") == F.col("d"), as_most).otherwise(as_other)).alias("group"))
    return dealt.join(sets.hint("merge"), "id").groupBy("group").applyInArrow(_linked(similarity), "a long, b long").distinct()


def classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS,
    width: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size (documents), kept (is it the class's smallest doc_id?)."""
    work = WorkFolder(docs.sparkSession)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = work.keep("sketch", slim.mapInArrow(_sketch(bands, width), SKETCH))

    def keep(name: str, table: DataFrame) -> DataFrame:
        return work.keep(name, table, count=False)  # that the folder is shared has shown in the sketch

    nodes = sketch.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"),
        F.first("keys", ignorenulls=True).alias("keys"),
    )
    nodes = keep("nodes", nodes.withColumn("id", F.monotonically_increasing_id()))
    placed = nodes.select("id", F.explode("keys").alias("bucket"))
    buckets = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    placed = keep("placed", placed.join(keep("buckets", buckets).hint("merge"), "bucket"))

    wanted = nodes.select("id", "node").join(placed.select("id").distinct(), "id", "left_semi")
    wanted = keep("wanted", wanted)
    # Always a merge join: whether few or many nodes are wanted, the same bytes move for each row.
    contents = sketch.where("content IS NOT NULL").select("node", "content").join(wanted.hint("merge"), "node")
    sets = keep("sets", contents.select("id", "content").mapInArrow(_sets, "id long, items array<long>").dropDuplicates(["id"]))
    weight = keep("weights", weights(sets).where(F.col("rest") >= F.lit(similarity) * F.col("size")))
    other_weight = weight.select(F.col("size").alias("other_size"), F.col("rest").alias("other_rest"), F.col("id").alias("hub"))

    # The hub of a bucket is the member with the smallest share of its own: the one most like the others.
    able = keep("able", placed.join(weight, "id").select("bucket", "id", (1 - F.col("rest") / F.col("size")).alias("own")))
    hub = F.min(F.struct("own", F.xxhash64("id", "bucket").alias("order"), "id")).alias("hub")
    hubs = keep("hubs", able.groupBy("bucket").agg(hub).select("bucket", F.col("hub.id").alias("hub")))
    members = keep("members", able.drop("own").join(hubs, "bucket"))
    stars = members.where("id != hub").select("id", "hub").distinct()
    stars = keep("stars", stars.join(weight, "id").join(other_weight, "hub").where(_possible(similarity)).select("id", "hub"))
    edges = keep("edges1", _verified(stars.select(F.col("id").alias("a"), F.col("hub").alias("b")), sets, similarity))
    roots = components(edges, work, "first")
    labels = wanted.select("id").join(roots, F.col("id") == F.col("node"), "left")
    labels = keep("labels", labels.select("id", F.coalesce("root", "id").alias("root")))
    # Hubs have met everyone of their buckets.
    there = members.where("id != hub").drop("hub").join(labels, "id").join(weight, "id")
    mixed = there.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = keep("mixed", mixed.where("low != high").select("bucket"))
    there = keep("there", there.join(mixed, "bucket", "left_semi"))
    edges = keep("edges2", edges.unionByName(_across(there, sets, similarity, work)))
    roots = components(edges, work, "second")

    grouped = nodes.select("id", "node", "least", "n").join(roots.withColumnRenamed("node", "child"), F.col("id") == F.col("child"), "left")
    grouped = keep("grouped", grouped.select("node", "least", "n", F.coalesce("root", "id").alias("root")))
    totals = grouped.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    named = keep("named", grouped.select("node", "root").join(totals, "root").drop("root"))
    found = sketch.select("doc_id", "node").join(named, "node", "left")
    return found.select(
        "doc_id",
        F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce(F.col("class_size").isNull() | (F.col("doc_id") == F.col("class_id")), F.lit(False)).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id stands for its class; rows without a doc_id cannot be named and stay."""
    lost = classes(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept")
    return docs.join(lost.select("doc_id").hint("merge"), "doc_id", "left_anti").select(*docs.columns)
