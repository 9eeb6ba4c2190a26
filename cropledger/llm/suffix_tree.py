"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context: the last 0 to ``depth`` words of what came before. The empty context predicts by the smoothed
counts of single words. A longer one is retained only if the context without its first word is, if it was seen ``least`` times, and if its
successors diverge from what that shorter context predicts: the log likelihood they gain, each successor seen twice or more on
its own and the others as one, must exceed ``nats`` for every one of them. The probability of a word in the longest retained context is

    (c(context, word) - discount) / c(context)  +  (what that leaves) * probability in the next shorter retained context

where the first term counts from two occurrences on. It sums to one over all words and the one place kept for unknown ones.

Counts do not fit a broadcast, so texts come to the counts. Documents are cut into blocks of about ``BLOCK`` tokens, written once. For
each depth a block asks for its distinct (context, word) pairs, with its own training counts and the probability so far; requests
meet by context, are summed over all blocks, and each block gets the totals of its pairs back, and what the divergence test needs of
each of its contexts. With all replies a block scores its documents. Words are 64-bit hashes at first; the first reply numbers those
seen twice or more, each further one numbers its pairs, which are the contexts of the next depth, so that a request, packed by block
and part, has about 4 bytes a distinct pair. The parts grow in number with the tokens. A context with more than its share of the
tokens is cut into so many parts, by word, as it has shares; a block that has the context asks all of them and adds up.

Defined results: a null text is empty, and has its end only. A null doc_id is never held out. Rows that repeat a doc_id are documents
of their own. The probability so far enters the divergence test, and only that, in eighths of a bit. Without
training documents every token has probability 1 / (V + 1) = 1. An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm import text as tx
from cropledger.session import WorkFolder

@dataclass(frozen=True)
class Shape:
    """Words of a context at most, occurrences and gain by successor that retain it, and what a seen successor gives up."""

    depth: int = 2
    least: int = 8
    nats: float = 2.0
    discount: float = 0.8


#: Weight of each word, and of the unknown one, in the empty context: fixed by the contract.
PRIOR = 0.5
#: Tokens of a block, and tokens for each part that counts meet in.
BLOCK, PART = 1 << 20, 1 << 22

LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
BLANK = np.array([tx.SPACE if b == 32 or 9 <= b <= 13 else tx.WORD for b in range(256)], np.uint8)
END = np.uint64(0x51AFD7ED558CCD6D)
PIECE = np.uint64(0xC4CEB9FE1A85EC53)
#: Marks the number of a context that is cut. Others are told by the part they lie in and the rest of their number.
CUT = np.uint64(1 << 62)

BLOCKS = "block long, size long, ids array<long>, held binary, lengths binary, tokens binary, places binary, words binary, seen binary"
REQUEST = "block long, part long, context binary, total binary, width binary, word binary, count binary, prior binary"
REPLY = "block long, part long, count binary, number binary, mass binary, entries binary, prior binary, gain binary, words long, tokens long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: Column) -> Column:
    """A fifth of all ids, by checksum of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the write they were made for, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _squeezed(values: np.ndarray, kind: str) -> bytes:
    """Numbers, compressed byte by byte of all of them: high bytes that hardly differ take no room."""
    values = np.ascontiguousarray(values, kind)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _released(data, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data.as_buffer()), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).reshape(-1).view(kind)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, the end of each row included, and tokens by row."""
    data, offsets = tx.flat(column)
    data = LOWER[data]
    start, length = tx.runs(data, offsets, BLANK)
    row = tx.owners(offsets, start)
    count = np.bincount(row, minlength=len(column)) + 1
    out = np.empty(int(count.sum()), np.uint64)
    last = np.cumsum(count) - 1
    out[last] = END
    inside = np.ones(len(out), bool)
    inside[last] = False
    out[inside] = tx.hashes(data, start, length)
    return out, count


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, hashes, lengths = [], [], [], []

        def block() -> pa.RecordBatch:
            words, place, often = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            count = np.concatenate(lengths)
            trains = np.repeat(~np.array(sum(held, []), bool), count)
            # Frequent words get low numbers, whose high bytes are zero.
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            return pa.RecordBatch.from_pylist(
                [{
                    "block": number, "size": len(place), "ids": sum(ids, []), "held": np.array(sum(held, []), np.uint8).tobytes(),
                    "lengths": _squeezed(count, "<u8"), "tokens": _squeezed(rank[place], "<u4"), "places": _squeezed(order, "<u4"),
                    "words": words.astype("<u8").tobytes(), "seen": _squeezed(np.bincount(place[trains], minlength=len(words)), "<u4"),
                }],
                _arrow(BLOCKS),
            )

        n = 0
        for batch in batches:
            for part in tx.pieces(batch, "text", 4 * size):
                found, count = tokens(part.column("text"))
                ids.append(part.column("doc_id").to_pylist())
                held.append(part.column("held").to_pylist())
                hashes.append(found)
                lengths.append(count)
                n += len(found)
                if n >= size:
                    yield block()
                    number, n = number + 1, 0
                    ids, held, hashes, lengths = [], [], [], []
        if ids:
            yield block()

    return run


def _pieces(totals: np.ndarray, share: float) -> np.ndarray:
    """Parts that contexts are cut into."""
    pieces = np.maximum(np.ceil(totals / share), 1).astype(np.int64)
    return np.where(pieces > 2, pieces, 1)


def _retained(total: np.ndarray, sums: dict[str, np.ndarray], nats: float) -> np.ndarray:
    """The divergence test, on the sums over a context's successors."""
    total, mass = total.astype(float), sums["mass"].astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = (total - mass) * np.log((total - mass) / total / np.maximum(1.0 - sums["prior"].astype(float), 1e-9))
    gain = sums["gain"].astype(float) + np.where(total > mass, rest, 0.0)
    return (sums["entries"] > 0) & (gain > nats * sums["entries"])


def _eighths(p: np.ndarray) -> np.ndarray:
    """Probabilities as eighths of a bit, down to 2^-31."""
    return np.minimum(np.rint(-8.0 * np.log2(p)), 255.0)


class Pairs:
    """The distinct (context, word) pairs of a block at one depth: what to ask, and in what order answers come."""

    def __init__(self, context: np.ndarray, contexts: np.ndarray, totals: np.ndarray, word: np.ndarray, count: np.ndarray,
                 prior: np.ndarray, parts: int, share: float):
        """``context`` points into ``contexts``; a context with ``totals`` above ``share`` is cut into pieces."""
        self.parts, pieces = parts, _pieces(totals, share)
        self.pieces = pieces
        piece = (tx.mix(word) % pieces[context].astype(np.uint64)).astype(np.uint64)
        # A block asks all pieces of a context, also those in which it has no pair: by a pair without a count.
        cut = np.flatnonzero(pieces > 1)
        extra = np.repeat(cut, pieces[cut])
        number = np.arange(len(extra)) - np.repeat(np.cumsum(pieces[cut]) - pieces[cut], pieces[cut])
        self.n = len(context)
        context = np.concatenate([context, extra])
        piece = np.concatenate([piece, number.astype(np.uint64)])
        blank = np.zeros(len(extra))
        whole = np.uint64(parts)
        part = np.where(pieces[context] > 1, tx.mix(contexts[context] + piece * PIECE), contexts[context]) % whole
        word = np.concatenate([word, blank.astype(np.uint64)])
        order = np.lexsort((word, context, part))
        part, self.context = part[order].astype(np.int64), context[order]
        self.order, self.totals = order, totals
        self.contexts = np.where(pieces > 1, contexts + CUT, contexts // whole)
        self.word = word[order]
        self.count = np.concatenate([count, blank.astype(np.int64)])[order]
        # Blocks that only hold a pair out of training leave its prior to others.
        self.prior = np.where(self.count > 0, np.concatenate([prior, blank])[order], 0.0)
        new = np.diff(part, prepend=-1) != 0
        self.first = np.flatnonzero(new)
        self.part = part[self.first]
        #: A header for every context of a part.
        self.header = np.flatnonzero(new | (np.diff(self.context, prepend=-1) != 0))

    def requests(self, block: int) -> Iterator[dict]:
        ends = np.append(self.first[1:], len(self.context))
        heads = np.searchsorted(self.header, self.first)
        width = np.diff(self.header, append=len(self.context))
        step = np.diff(self.word, prepend=np.uint64(0))  # of words in ascending order within a context
        step[self.header] = self.word[self.header]
        for part, a, b, h, g in zip(self.part, self.first, ends, heads, np.append(heads[1:], len(self.header))):
            own = self.context[self.header[h:g]]
            yield {
                "block": block, "part": int(part), "context": _squeezed(self.contexts[own], "<u8"),
                "total": _squeezed(self.totals[own], "<u8"), "width": _squeezed(width[h:g], "<u4"),
                "word": _squeezed(step[a:b], "<u8"), "count": _squeezed(self.count[a:b], "<u4"),
                "prior": _squeezed(self.prior[a:b], "<u1"),
            }

    def read(self, replies: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Totals and numbers of the pairs, and sums by context, from the replies of all parts."""
        count, number = _counts(replies, least, self.parts)
        found, numbers = np.empty(len(self.order), np.int64), np.empty(len(self.order), np.uint64)
        found[self.order], numbers[self.order] = count, number
        by = self.context[self.header]
        entries = _every(replies, "entries", "<u4")
        sums = {"entries": np.bincount(by, entries, len(self.contexts))}
        cut = self.pieces[by] > 1
        for k, kind in SUMS.items():
            told = entries > 0 if k == "mass" else (entries > 0) & cut
            sums[k] = np.bincount(by[told], _every(replies, k, kind), len(self.contexts))
        return found[: self.n], numbers[: self.n], sums


def _every(replies: pa.Table, name: str, kind: str) -> np.ndarray:
    """A column of the replies, in the order of parts."""
    return np.concatenate([np.empty(0, kind), *[_released(x, kind) for x in replies.sort_by("part").column(name)]])


def _counts(replies: pa.Table, least: float, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals and numbers of pairs; those below ``least`` have none. A number is a rank in a part, and the part."""
    count = _every(replies, "count", "<u8").astype(np.int64)
    number = np.zeros(len(count), np.uint64)
    own = replies.sort_by("part")
    ranks = [_released(x, "<u8") for x in own.column("number")]
    part = np.repeat(own.column("part").to_numpy(), [len(x) for x in ranks]).astype(np.uint64)
    number[count >= least] = np.concatenate([np.empty(0, np.uint64), *ranks]) * np.uint64(parts) + part
    return count, number


def _word_requests(row: dict, parts: int) -> Iterator[dict]:
    """What a block asks of single words, each its own context, so that the empty one is spread over all parts.

    Parts are ranges of hashes, so that the words of a block lie in their order whatever the number of parts.
    """
    words, seen = np.frombuffer(row["words"].as_buffer(), "<u8"), _released(row["seen"], "<u4")
    part = ((words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(first, [*first[1:], len(words)]):
        none = np.zeros(b - a)
        yield {
            "block": row["block"].as_py(), "part": int(part[a]), "context": words[a:b].tobytes(), "total": _squeezed(none, "<u8"),
            "width": _squeezed(none + 1, "<u4"), "word": _squeezed(none, "<u8"), "count": _squeezed(seen[a:b], "<u4"),
            "prior": _squeezed(none, "<u1"),
        }


#: What is summed by context beside its entries, where it has any; the last two only for contexts that are cut, rounded for all blocks alike.
SUMS = {"mass": "<u8", "prior": "<f4", "gain": "<f4"}


def _answered(depth: int, parts: int, share: float, shape: Shape):
    def run(key: tuple, asked: pa.Table) -> pa.Table:
        return _answer(key[0].as_py(), asked, depth, parts, share, shape)

    return run


def _answer(part: int, asked: pa.Table, depth: int, parts: int, share: float, shape: Shape) -> pa.Table:
    """Sum the requests of one part over all blocks; the reply to a block is in the order of its request.

    Single words are numbered from two occurrences on, as they follow others; pairs where they may be contexts. Of a context that lies
    in this part alone and is not retained, a block learns only which pairs may be contexts.
    """
    hashed = depth == 0
    least = 2 if hashed else shape.least if depth < shape.depth else 1 << 62
    contexts = [np.frombuffer(x.as_buffer(), "<u8") if hashed else _released(x, "<u8") for x in asked.column("context")]
    widths = [_released(x, "<u4") for x in asked.column("width")]
    context = np.concatenate([np.repeat(c, w) for c, w in zip(contexts, widths)])
    total = np.concatenate([np.repeat(_released(t, "<u8"), w) for t, w in zip(asked.column("total"), widths)])
    word = np.cumsum(np.concatenate([_released(x, "<u8") for x in asked.column("word")]), dtype=np.uint64)
    width = np.concatenate(widths)
    start = np.cumsum(width) - width
    word -= np.repeat(np.where(start > 0, word[start - 1], np.uint64(0)), width)
    count = np.concatenate([_released(x, "<u4") for x in asked.column("count")]).astype(np.int64)
    prior = np.concatenate([_released(x, "<u1") for x in asked.column("prior")])
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    new = np.ones(len(order), bool)
    new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    summed = np.add.reduceat(count[order], first)
    seen = summed > 1
    named = summed >= least
    rank = np.where(named, np.cumsum(named), 0)
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1

    # What the test needs of a context: successors seen at least twice, and how much better it predicts them.
    context, total, prior = context[first], total[order][first].astype(float), np.maximum.reduceat(prior[order], first) / -8.0
    known = np.flatnonzero(np.diff(context, prepend=context[:1] + np.uint64(1)) != 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(seen, summed * (np.log(summed / total) - prior * np.log(2.0)), 0.0)
    sums = {
        "mass": np.where(seen, summed, 0), "entries": seen.astype(int), "prior": np.where(seen, 2.0**prior, 0.0),
        "gain": np.where(np.isfinite(gain), gain, 0.0),
    }
    sums = {k: np.add.reduceat(v, known) for k, v in sums.items()}
    sums |= {k: sums[k].astype("<f4") for k in ("prior", "gain")}
    cut = (_pieces(total[known], share) > 1) & (not hashed)
    kept = hashed | cut | _retained(total[known], sums, shape.nats)
    of = np.repeat(np.arange(len(known)), np.diff(known, append=len(context)))
    shown = np.where(kept[of] | named, summed, 0)
    sums["entries"] = np.where(kept, sums["entries"], 0)
    out, at = [], 0
    for k, (block, own, width) in enumerate(zip(asked.column("block").to_pylist(), contexts, widths)):
        mine = pair[at : at + int(width.sum())]
        at += len(mine)
        place = np.searchsorted(context[known], own)
        entries = sums["entries"][place]
        out.append(
            {"block": block, "part": part, "count": _squeezed(shown[mine], "<u8"), "number": _squeezed(rank[mine][named[mine]], "<u8")}
            | {"entries": _squeezed(entries, "<u4")}
            | {name: _squeezed(sums[name][place[(entries > 0) & (cut[place] | (name == "mass"))]], kind) for name, kind in SUMS.items()}
            | {"words": int((summed > 0).sum()) if k == 0 else None, "tokens": int(summed.sum()) if k == 0 else None}
        )
    return pa.Table.from_pylist(out, _arrow(REPLY))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"array<long>": pa.list_(pa.int64()), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split(" ") for column in schema.split(", "))])


class Walk:
    """The tokens of a block, walked down the tree one depth after the other."""

    def __init__(self, row: dict, parts: int, shape: Shape):
        self.block, self.ids, self.parts, self.shape = row["block"].as_py(), row["ids"].as_py(), parts, shape
        self.held = np.frombuffer(row["held"].as_buffer(), np.uint8) == 1
        self.lengths = _released(row["lengths"], "<u8").astype(np.int64)
        self.word = _released(row["tokens"], "<u4").astype(np.int64)
        self.places = _released(row["places"], "<u4")
        self.trains = np.repeat(~self.held, self.lengths)
        first = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.word)) - np.repeat(first, self.lengths)

    def begin(self, replies: pa.Table, total: int, distinct: int) -> None:
        """Single words, from the replies in the order of their hashes."""
        counts, numbers = (x[self.places] for x in _counts(replies, 2, self.parts))
        self.total, self.known, self.names, self.numbers = total, counts, numbers, numbers
        self.base = (counts + PRIOR) / (total + PRIOR * (distinct + 1))
        self.p = self.base[self.word]
        self.pair, self.counts, self.inside = self.word, counts, np.ones(len(self.word), bool)

    def deeper(self, depth: int) -> Pairs:
        """Pairs of the contexts of ``depth`` words that may be retained."""
        before = np.concatenate([[0], self.pair[:-1]])
        often = np.concatenate([[0], np.append(self.counts, 0)[self.pair[:-1]]])  # no pair: -1, none
        self.at = np.flatnonzero((self.place >= depth) & self.inside & (often >= self.shape.least))
        # Words seen less than twice follow no context twice: as one blank they ask for the context only.
        n = len(self.names)
        follows = np.where(self.known > 1, np.arange(n), n)[self.word[self.at]]
        key, self.which = np.unique(before[self.at] * (n + 1) + follows, return_inverse=True)
        context, word = np.divmod(key, n + 1)
        names = np.append(self.names, np.uint64(0))[word]
        used, self.context = np.unique(context, return_inverse=True)
        self.totals = self.counts[used]
        prior = np.empty(len(key))
        prior[self.which] = _eighths(self.p[self.at])
        count = np.bincount(self.which[self.trains[self.at] & (follows < n)], minlength=len(key))
        share = max(self.total, 1) / self.parts
        pairs = Pairs(self.context, self.numbers[used], self.totals, names, count, prior, self.parts, share)
        self.cut = pairs.pieces > 1
        return pairs

    def down(self, counts: np.ndarray, numbers: np.ndarray, sums: dict[str, np.ndarray]) -> None:
        """Retain contexts and refine the probabilities of their successors. Of contexts that are not cut, only the retained have entries."""
        self.numbers = numbers
        total, mass, entries = self.totals.astype(float), sums["mass"], sums["entries"]
        retained = np.where(self.cut, _retained(total, sums, self.shape.nats), entries > 0)
        own = self.context[self.which]
        seen = counts[self.which]
        direct = np.where(seen > 1, seen - self.shape.discount, 0.0) / total[own]
        left = (total - mass + self.shape.discount * entries) / np.maximum(total, 1.0)
        self.p[self.at] = np.where(retained[own], direct + left[own] * self.p[self.at], self.p[self.at])
        self.inside = np.zeros(len(self.word), bool)
        self.inside[self.at] = retained[own]
        self.pair = np.full(len(self.word), -1)
        self.pair[self.at] = self.which
        self.counts = counts

    def scores(self) -> pa.Table:
        first = np.cumsum(self.lengths) - self.lengths

        def by_row(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, first)

        return pa.table({
            "doc_id": pa.array(self.ids, pa.int64()), "held_out": self.held, "n_tokens": self.lengths,
            "n_known": by_row((self.known[self.word] > 0).astype(np.int64)),
            "train_tokens": np.full(len(first), self.total, np.int64),
            "base_score": by_row(np.log10(self.base)[self.word]), "score": by_row(np.log10(self.p)),
        })


def _table(pairs: Pairs, block: int) -> pa.Table:
    return pa.Table.from_pylist(list(pairs.requests(block)), _arrow(REQUEST))


def _first_requests(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                yield from pa.Table.from_pylist(list(_word_requests(row, parts)), _arrow(REQUEST)).to_batches()

    return run


def _asking(depth: int) -> Callable[[Walk], pa.Table]:
    return lambda walk: _table(walk.deeper(depth), walk.block)


def _with_replies(depth: int, total: int, distinct: int, parts: int, shape: Shape, finish: Callable[[Walk], pa.Table]):
    """Walk a block as deep as there are replies."""

    def run(key: tuple, blocks: pa.Table, replies: pa.Table) -> pa.Table:
        walk = Walk({name: blocks.column(name)[0] for name in blocks.column_names}, parts, shape)
        for d in range(depth):
            own = replies.filter(pc.equal(replies.column("depth"), d))
            if d:
                walk.down(*walk.deeper(d).read(own, shape.least if d < shape.depth else np.inf))
            else:
                walk.begin(own, total, distinct)
        return finish(walk)

    return run


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    with _shuffles_removed(docs.sparkSession):
        return _score(docs, doc_id, text, shape)


def _score(docs: DataFrame, doc_id: str, text: str, shape: Shape) -> DataFrame:
    work = WorkFolder(docs.sparkSession)
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id).cast("long")).alias("held"), F.col(text).alias("text")
    )
    blocks = work.keep("blocks", slim.mapInArrow(_blocks(BLOCK), BLOCKS))
    held = blocks.agg(F.sum("size").alias("n")).first()["n"] or 0
    parts = max(1, -(-held // PART))
    asked = blocks.select("block", "words", "seen").mapInArrow(_first_requests(parts), REQUEST)
    replies = None
    total = distinct = 0
    for d in range(shape.depth + 1):
        answers = asked.groupBy("part").applyInArrow(_answered(d, parts, max(total, 1) / parts, shape), REPLY).withColumn("depth", F.lit(d))
        answers = work.keep(f"replies{d}", answers)
        if d == 0:
            sums = answers.agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).first()
            total, distinct = sums["tokens"] or 0, sums["words"] or 0
            # Nothing asks for hashes any more.
            blocks = work.keep("slim", blocks.drop("words", "seen"))
            work.drop("blocks")
        replies = answers if replies is None else replies.unionByName(answers)
        both = blocks.groupBy("block").cogroup(replies.drop("words", "tokens").groupBy("block"))
        if d < shape.depth:
            asked = both.applyInArrow(_with_replies(d + 1, total, distinct, parts, shape, _asking(d + 1)), REQUEST)
    scores = both.applyInArrow(_with_replies(shape.depth + 1, total, distinct, parts, shape, Walk.scores), SCORES)
    scores = work.keep("scores", scores)
    work.drop("slim", *[f"replies{d}" for d in range(shape.depth + 1)])
    return scores
