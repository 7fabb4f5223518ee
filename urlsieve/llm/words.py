"""Words, word hashes and shingle hashes of whole texts, for many documents at once in NumPy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, A-Z lower-cased. Arrow batches
are cut into chunks of whole documents of about a megabyte before anything is copied, so memory follows the longest document only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_rng = np.random.default_rng(20240607)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_VALUE[_SPACE] = 0
CASED = _VALUE.copy()
_VALUE[65:91] = _VALUE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_power = np.ones(1, np.uint64)


def give_back() -> None:
    """Hand memory that this Python worker has freed back to the system; workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    """At least n powers of the hash base."""
    global _power
    if len(_power) < n:
        more = np.full(max(n, 2 * len(_power), 256), _BASE, np.uint64)
        more[0] = 1
        _power = np.multiply.accumulate(more)
    return _power


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column end to end, and its n + 1 offsets. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows whose texts together have about ``size`` bytes, with flat bytes and offsets."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(before, before[at] + size, "right")) - 1)
        part = batch.slice(at, end - at)
        yield part, *flat(part.column(text))
        at = end


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word, and for each document the index of its first word (n + 1 values)."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    first[edge] = inside[edge]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, value: np.ndarray = _VALUE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, start of each word, first word of each document. With the values CASED, A and a differ."""
    starts, first = word_starts(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, first
    stretch = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, stretch)
    terms = value[data[starts[0]:]] * powers(int(stretch.max()))[place]
    return mix(np.add.reduceat(terms, starts - starts[0])), starts, first


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and each document's first one (n + 1 values).

    A document of fewer words has its whole sequence as the only one; without words it has none.
    """
    words = np.diff(first)
    count = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    begin = np.concatenate(([0], np.cumsum(count)))
    total = int(begin[-1])
    at = np.arange(total) - np.repeat(begin[:-1], count) + np.repeat(first[:-1], count)
    ends = np.repeat(first[1:], count)
    padded = np.concatenate((hashes, np.zeros(k, np.uint64)))
    out = np.full(total, np.uint64(k))
    for j in range(k):
        here = at + j
        out += np.where(here < ends, padded[np.minimum(here, len(hashes))] * _PLACE[j], np.uint64(0))
    short = np.repeat(words < k, count)
    out[short] += np.repeat(words, count)[short].astype(np.uint64) * _PLACE[k]
    return mix(out), begin
