"""Vectorised work on Arrow text buffers: words, hashes, and chunks of bounded size.

A chunk is the UTF-8 bytes of several texts, one behind the other, with their offsets. Nothing here
looks at one character or word at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; one longer text makes a longer chunk.
CHUNK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    text = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return text[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``size`` bytes of text each: (rows, bytes, offsets)."""
    if not batch.num_rows:
        return
    data, offsets = buffers(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        at = offsets[first : last + 1]
        yield batch.slice(first, last - first), data[at[0] : at[-1]], at - at[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and for each text the number of words before it (one more entry than texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[:-1][(offsets[:-1] < n)]
    begins[cut] = inside[cut]
    cut = cut[cut > 0] - 1
    ends[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash's base and of its inverse, modulo 2 to the 64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, inverse)]
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which span_hash() reads the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(len(data) + 1)[0][:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes between starts and ends, the same wherever those bytes stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64))


def shingles(word_hash: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``k``-word shingles of each text as 64-bit hashes, in rising order, with their bounds.

    A text with fewer words has one shingle of all of them, one without words has none.
    """
    counts = np.diff(bounds)
    n = len(word_hash)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, n - k + 1), np.uint64)
        for i in range(k):
            rolled = mix(rolled * np.uint64(3) + word_hash[i : n - k + 1 + i] + np.uint64(i + 1)) if len(rolled) else rolled
    doc = np.repeat(np.arange(len(counts)), counts)
    whole = np.ones(len(rolled), bool)
    if len(rolled):
        whole = doc[: n - k + 1] == doc[k - 1 :]
    hashes, owners = [rolled[whole]], [doc[: n - k + 1][whole] if len(rolled) else np.zeros(0, np.int64)]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        h = np.zeros(1, np.uint64)
        for i, w in enumerate(word_hash[bounds[d] : bounds[d + 1]]):
            h = mix(h * np.uint64(3) + w + np.uint64(i + 1))
        hashes.append(mix(h + np.uint64(counts[d])))
        owners.append(np.array([d]))
    h, o = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[new], o[new]
    return h, np.searchsorted(o, np.arange(len(counts) + 1))
