"""Packing documents into training sequences by minimum bin slack over a histogram of lengths.

A document's ids, with an end id, are cut into full sequences and one rest. How the rests share sequences depends on how
many there are of each length, and on nothing else: at most 1,023 numbers, whatever the corpus. From those the driver
draws up the plan. For the longest length left, a bitset subset-sum over the lengths left (each as often as it occurs)
tells which fills are within reach; the fullest is taken, its counts are found by walking back through the bitsets, and
it is used as often as the counts allow. Each use leaves some length with fewer pieces than the fill wants, so there are
at most sum(1 + capacity / length) fills, about 8,700 for 1,024.

Every rest has a rank among those of its length: counted inside its task when it is cut, plus what earlier tasks have,
by a running sum per length. Rank and length give sequence and offset by binary search in the plan.

Defined results: a null or empty text is one end id. Rows are documents of their own, repeated or null doc_ids too. An
empty table gives an empty table. A sequence that is not full is padded to the capacity, unless its size is a power of two.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cropledger.session import WorkFolder

CAPACITY = 1024
END = 0
VOCABULARY = "byte_bpe_50k.json"

CUT = "block long, place long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to the ids that tokenizers gives without adding special tokens; literals of added tokens in the text are their one id.

    Where the file is a plain byte-level BPE whose merges stand in the order of their ids, tiktoken gives the same ids
    from the same vocabulary in a quarter of the time; any other file goes through tokenizers itself, as does a text with a
    literal of an added token that takes blanks or words beside it into account, or that overlaps another.
    """
    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary, merges = spec["model"].get("vocab", {}), spec["model"].get("merges", [])
    step = spec.get("pre_tokenizer") or {}
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    places = [vocabulary.get(x, -1) for x in joined]
    plain = (
        spec["model"].get("type") == "BPE" and step.get("type") == "ByteLevel" and not step.get("add_prefix_space")
        and step.get("use_regex", True) and not spec.get("normalizer") and places == sorted(places) and -1 not in places
        and not spec["model"].get("ignore_merges") and not spec["model"].get("dropout")
    )
    if not plain:
        return lambda text: slow.encode(text, add_special_tokens=False).ids
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    added = spec.get("added_tokens", [])
    special = {x["content"]: x["id"] for x in added}
    ranks = {bytes(byte_of[c] for c in word): n for word, n in vocabulary.items() if word not in special}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    alone = not any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added) and all(
        not a[k:] or not b.startswith(a[k:]) for a in special for b in special for k in range(len(a)) if (a, 0) != (b, k)
    )

    def encode(text: str) -> list[int]:
        if not any(literal in text for literal in special):
            return fast.encode_ordinary(text)
        return fast.encode(text, allowed_special="all") if alone else slow.encode(text, add_special_tokens=False).ids

    return encode


def _cut(path: str, capacity: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = pc.dictionary_encode(pc.fill_null(batch.column("text"), ""))
            ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            cuts: dict[int, list[tuple]] = {}
            for doc, group in zip(ids, texts.indices.to_pylist(), strict=True):
                if group not in cuts:
                    tokens = np.array([*encode(texts.dictionary[group].as_py()), end], "<u4")
                    n, raw = len(tokens), tokens.tobytes()
                    cuts[group] = [
                        (s, m := min(capacity, n - s), zlib.crc32(raw[4 * s : 4 * (s + m)]), n, tokens[s : s + m] if with_ids else None)
                        for s in range(0, n, capacity)
                    ]
                for s, m, crc, n, held in cuts[group]:
                    rows.append((block, seen[m], doc, s, m, crc, n, held))
                    seen[m] += 1
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            names = ["block", "place", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 8 if with_ids else 7]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(columns[k], kinds[k]) for k in range(len(names))], names=names)

    return run


def cut(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; block and place number those of one length."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    clean = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return clean.mapInArrow(_cut(str(path), capacity, end, with_ids), CUT + (", ids array<int>" if with_ids else ""))


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Of the fills that hold the longest length, the one closest to the capacity, as length -> how often."""
    lengths = sorted(counts, reverse=True)
    mask = (1 << (capacity + 1)) - 1
    reach = [1 << lengths[0]]
    for k, n in enumerate(lengths):
        left = min(counts[n] - (k == 0), capacity // n)
        bits, part = reach[-1], 1
        while left > 0:  # 1, 2, 4, ... and what is left over make every number of copies
            use = min(part, left)
            bits |= (bits << (n * use)) & mask
            left, part = left - use, part * 2
        reach.append(bits)
        if bits >> capacity:
            break
    size = reach[-1].bit_length() - 1
    found = {lengths[0]: 1}
    for k in range(len(reach) - 2, -1, -1):
        n = lengths[k]
        while not reach[k] >> size & 1:
            size -= n
            found[n] = found.get(n, 0) + 1
    return found


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Rows by (length, first rank): the pieces from that rank on go to sequence ``first`` onwards, ``each`` a sequence."""
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        fill = fullest(left, capacity)
        uses = min(left[n] // q for n, q in fill.items())
        offset = 0
        for n, q in sorted(fill.items(), reverse=True):
            rows.append((n, rank[n], sequence, q, offset))
            offset += n * q
            rank[n] += q * uses
            left[n] -= q * uses
            if not left[n]:
                del left[n]
        sequence += uses
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "first", "each", "offset"), table.T, strict=True))


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shared.value
        # Both parts of the key in one sorted number: ranks stay below 2^52, lengths below 2^11.
        keys = (by["length"] << 52) + by["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            row = np.searchsorted(keys, (length << 52) + rank, "right") - 1
            nth = rank - by["rank"][row]
            sequence = by["first"][row] + nth // by["each"][row]
            offset = by["offset"][row] + nth % by["each"][row] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "rank"), pa.array(sequence), pa.array(offset)],
                names=[*(c for c in batch.schema.names if c != "rank"), "sequence_id", "offset"],
            )

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece of a written table its sequence and offset."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    shared = spark.sparkContext.broadcast(plan(totals, capacity))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["block", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    names = [c for c in pieces.columns if c not in ("block", "place")]
    kinds = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in names)
    return ranked.select(*names, "rank").mapInArrow(_place(shared), f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, **options) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``options`` as for cut()."""
    work = WorkFolder(docs.sparkSession)
    pieces = work.keep("pieces", cut(docs, **options))
    return place(pieces, options.get("capacity", CAPACITY))


def sequences(docs: DataFrame, *, pad: int = END, **options) -> DataFrame:
    """The sequences themselves: sequence_id, ids, size. ``size`` ids are real, the rest is padding."""
    capacity = options.get("capacity", CAPACITY)
    packed = pack(docs, with_ids=True, **options)
    whole = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = whole.select("sequence_id", F.flatten("parts.ids").alias("ids")).withColumn("size", F.size("ids"))
    power = F.bit_count("size") == 1
    padding = F.when(power, F.lit(0)).otherwise(F.lit(capacity) - F.col("size"))
    return ids.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad), padding.cast("int"))))
