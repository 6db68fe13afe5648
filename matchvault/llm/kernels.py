"""Array kernels over the UTF-8 bytes of a batch of texts, for use inside tasks.

A batch is cut into blocks of whole texts; working memory is about forty times a block, and a block is larger
than ``BLOCK`` only where a single text is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
# Odd multiplier of the polynomial hash and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK):
    """``(rows, data, offsets)`` for runs of whole texts: a slice of rows, their bytes, where each begins."""
    array = batch.column(batch.schema.get_field_index(column))
    n = len(array)
    if n == 0:
        return
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, where, what = array.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[array.offset : array.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, n)
        yield slice(low, high), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def mix(values, seed: int = 0):
    """Bijective scrambling of 64-bit values; each seed is another permutation."""
    with np.errstate(over="ignore"):
        x = values + np.uint64(((seed + 1) * BASE) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_POWERS = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i below n (kept between calls, grown by doubling)."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        known = np.ones(size, dtype=np.uint64)
        done = 1
        with np.errstate(over="ignore"):
            while done < size:
                np.multiply(known[:done], np.uint64(pow(base, done, 1 << 64)), out=known[done : 2 * done])
                done *= 2
        if size <= 4 * BLOCK:
            _POWERS[base] = known
    return known[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which ``span_hash`` reads the hash of any span."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(running: np.ndarray, starts, ends) -> np.ndarray:
    """64-bit hash of each span, equal for equal bytes wherever they stand."""
    with np.errstate(over="ignore"):
        return mix((running[ends] - running[starts]) * powers(BASE_INVERSE, len(running))[starts])


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """``(starts, ends, first)`` of maximal runs of bytes that are no white space; no run crosses texts."""
    inside = ~space[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5):
    """``(hashes, first)``: the sorted distinct hashes of each text's ``width``-word shingles.

    Words are lower-cased in A-Z. A text with fewer words has its whole sequence as one; one without words none.
    """
    starts, ends, first = words(data, offsets)
    token = span_hash(prefix_hash(LOWER[data]), starts, ends)
    count = np.diff(first)
    texts = np.flatnonzero(count)
    full = np.zeros(len(token) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        if len(token) >= width:
            run = np.zeros(len(token) - width + 1, dtype=np.uint64)
            for i in range(width):
                run = run * np.uint64(BASE) + token[i : len(token) - width + 1 + i]
            full[: len(run)] = mix(run, width)
        for t in np.flatnonzero((count > 0) & (count < width)):
            whole = np.uint64(count[t])
            for x in token[first[t] : first[t + 1]]:
                whole = whole * np.uint64(BASE) + x
            full[first[t]] = mix(np.array([whole], dtype=np.uint64), 99)[0]
    sizes = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=bounds[1:])
    hashes = np.empty(bounds[-1], dtype=np.uint64)
    for t in texts:
        part = full[first[t] : first[t] + sizes[t]]
        hashes[bounds[t] : bounds[t + 1]] = np.sort(part)
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[bounds[:-1][sizes > 0]] = True
    before = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.cumsum(keep, out=before[1:])
    return hashes[keep], before[bounds]


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow list column with ``values[bounds[i]:bounds[i + 1]]`` in row i."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def signed(values) -> np.ndarray:
    return np.asarray(values, dtype=np.uint64).view(np.int64)
