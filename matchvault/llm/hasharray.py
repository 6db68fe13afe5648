"""Sorted hash arrays in files of the shared folder, written by tasks and memory-mapped by the tasks that read them.

An array holds 64-bit keys in ascending order and a row of counts for each. The leading bits of a key choose a bucket of
``BUCKET`` keys or so, 32 more are stored: of absent keys, about one in 2^32 / ``BUCKET`` is taken for another. Rows are
stored as one byte where they are among the 255 commonest of the array, the others apart.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs

BUCKET = 8


def _common(values: np.ndarray):
    """``(codes, table, where, others)``: rows as bytes into a table, 255 for the rows listed apart."""
    if not len(values):
        return np.zeros(0, np.uint8), values, np.zeros(0, np.uint32), values
    # A row of small values is one number; rows with a larger value are rare and listed apart.
    part, small = 64 // values.shape[1], np.ones(len(values), dtype=bool)
    whole = values[:, 0].astype(np.uint64)
    for i in range(values.shape[1] if part < 64 else 0):
        small &= values[:, i] < 1 << part
        if i:
            whole |= values[:, i].astype(np.uint64) << np.uint64(part * i)
    ordered = np.sort(whole[small])
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    often = np.sort(ordered[at[np.argsort(-np.diff(at, append=len(ordered)), kind="stable")[:255]]])
    code = np.searchsorted(often, whole)
    hit = small & (code < len(often))
    hit[hit] = often[code[hit]] == whole[hit]
    codes = np.where(hit, code, 255).astype(np.uint8)
    shifts = np.arange(values.shape[1], dtype=np.uint64) * np.uint64(part)
    table = often[:, None] >> shifts & np.uint64((1 << part) - 1)
    where = np.flatnonzero(~hit).astype(np.uint32)
    return codes, table.astype(np.int64), where, values[where]


def packed(keys: np.ndarray, values: np.ndarray) -> bytes:
    """The array of ascending ``keys`` with one row of ``values`` each, as bytes."""
    bits = max(0, (len(keys) // BUCKET).bit_length() - 1)
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    begins = np.searchsorted(bucket, np.arange((1 << bits) + 1)).astype(np.uint32)
    del bucket
    stored = ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    codes, table, where, others = _common(values)
    head = np.array([len(keys), bits, values.shape[1], len(table), len(where)], dtype=np.int64)
    parts = [head, begins, stored, codes, table.astype(np.int64), where, others.astype(np.int64)]
    return b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)


class HashArray:
    """Reads an array that begins at ``at`` of ``buffer``; nothing is copied but what a lookup returns."""

    def __init__(self, buffer, at=0):
        def take(kind, n):
            nonlocal at
            out = np.frombuffer(buffer, kind, n, at)
            at += -(-out.nbytes // 8) * 8
            return out

        n, self.bits, self.width, kinds, apart = take(np.int64, 5).tolist()
        self.begins = take(np.uint32, (1 << self.bits) + 1)
        self.stored, self.codes = take(np.uint32, n), take(np.uint8, n)
        self.table = take(np.int64, kinds * self.width).reshape(-1, self.width)
        self.where = take(np.uint32, apart)
        self.others = take(np.int64, apart * self.width).reshape(-1, self.width)
        self.end = at

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each of ``keys``; zeros for those that are not in the array."""
        out = np.zeros((len(keys), self.width), dtype=np.int64)
        if not len(self.stored) or not len(keys):
            return out
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        wanted = ((keys << np.uint64(self.bits)) >> np.uint64(32)).astype(np.uint32)
        at, end = self.begins[bucket].astype(np.int64), self.begins[bucket + 1].astype(np.int64)
        # In steps of halving size past the smaller keys of the bucket.
        for step in reversed(range(int((end - at).max()).bit_length())):
            further = at + ((1 << step) - 1)
            less = self.stored.take(further, mode="clip") < wanted
            less &= further < end
            at += less.astype(np.int64) << step
        found = np.flatnonzero((at < end) & (self.stored.take(at, mode="clip") == wanted))
        at = at[found]
        codes = self.codes[at]
        plain = codes < 255
        out[found[plain]] = self.table[codes[plain]]
        out[found[~plain]] = self.others[np.searchsorted(self.where, at[~plain])]
        return out


def _file(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def store(path: str, *arrays: bytes) -> None:
    """Write ``path`` at once: a task that runs again, or twice at a time, leaves one whole file of the same bytes."""
    files, name = _file(path)
    files.create_dir(name.rsplit("/", 1)[0], recursive=True)
    draft = f"{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        for part in arrays:
            out.write(part)
    files.move(draft, name)


def load(path: str, n: int) -> list[HashArray] | None:
    """The ``n`` arrays of a file, mapped where the folder is mounted and read where it is a remote store."""
    files, name = _file(path)
    try:
        source = pa.memory_map(name) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(name)
    except FileNotFoundError:
        return None
    buffer, arrays, at = source.read_buffer(), [], 0
    for _ in range(n):
        arrays.append(HashArray(buffer, at))
        at = arrays[-1].end
    return arrays
