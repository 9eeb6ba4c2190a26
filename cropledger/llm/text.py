"""Arrow text columns as flat byte arrays, and hashes of all their words at once."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE, WORD, MARK = 0, 1, 2
#: Class of each UTF-8 byte: white space and control, letters, digits and everything beyond ASCII, other marks.
KINDS = np.array(
    [WORD if b >= 128 or chr(b).isalnum() else MARK if b > 32 and b != 127 else SPACE for b in range(256)], np.uint8
)
#: The same with marks as white space.
WORDS_ONLY = np.where(KINDS == WORD, WORD, SPACE).astype(np.uint8)

BASE = np.uint64(0x9E3779B97F4A7C15)
LONG_RUN = 1024
POWERS = np.multiply.accumulate(np.full(LONG_RUN, BASE, np.uint64))
CHUNK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: each input bit moves each output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and where each row starts (one more: the end); null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def runs(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every run of bytes of one class, never across two rows."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = kinds[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets] = True
    at = np.flatnonzero(edge)
    inside = kind[at[:-1]] != SPACE
    return at[:-1][inside], np.diff(at)[inside]


def hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of each run; equal bytes, equal hash, wherever they stand."""
    out = np.empty(len(start), np.uint64)
    for at in range(0, len(start), CHUNK):
        s, n = start[at : at + CHUNK], np.minimum(length[at : at + CHUNK], LONG_RUN)
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        value = (data[np.repeat(s, n) + place].astype(np.uint64) + np.uint64(1)) * POWERS[place]
        out[at : at + CHUNK] = mix(np.add.reduceat(value, first)) if len(s) else 0
    for k in np.flatnonzero(length > LONG_RUN):
        whole = data[start[k] : start[k] + length[k]].tobytes()
        out[k] = np.uint64(int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little"))
    return out


def owners(offsets: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Row that each byte position lies in."""
    return np.searchsorted(offsets, start, "right") - 1


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 20, rows: int = 1 << 20):
    """Slices of a batch with at most so many bytes of text and rows, one row at least: what one numpy pass holds."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for k, n in enumerate(size):
        if held and held + n > most or k - at >= rows:
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += int(n)
    if batch.num_rows > at:
        yield batch.slice(at)
