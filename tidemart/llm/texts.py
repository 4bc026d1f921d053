"""Arrow text columns as numpy bytes: words, hashes and bounded slices of a batch.

A worker function gets Arrow batches. ``pieces_of`` cuts them into slices of a
few megabytes, so that memory does not follow the batch size; ``utf8`` shows a
text column as its bytes and row offsets without making Python strings.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_TABLE_SEED = 20_240_229
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FACTOR_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_HASH = np.random.default_rng(_TABLE_SEED).integers(1, 1 << 63, size=256, dtype=np.uint64)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry mask of the bytes that end a word."""
    mask = np.zeros(256, dtype=bool)
    for low, high in ranges:
        mask[low : high + 1] = True
    return mask


SPACES = separators((0x20, 0x20), (0x09, 0x0D))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces_of(batch: pa.RecordBatch, text: int | str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``limit`` bytes of text, or one longer row."""
    n = batch.num_rows
    if n == 0:
        return
    lengths = np.diff(utf8(batch.column(text))[1])
    ends = np.cumsum(lengths)
    start = 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + limit, "right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def kept_in_worker(name: str) -> dict:
    """A dictionary that stays in a worker process from task to task.

    Functions come to a worker by value, with new module variables for each task;
    a module of the process's own outlives them.
    """
    held = sys.modules.setdefault("_tidemart_kept", types.ModuleType("_tidemart_kept"))
    return held.__dict__.setdefault(name, {})


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser over 64 bits: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_powers: dict[str, np.ndarray] = {}


def _power(n: int, inverse: bool) -> np.ndarray:
    key = "inverse" if inverse else "power"
    have = _powers.get(key)
    if have is None or len(have) < n:
        base = np.full(max(n, SLICE_BYTES + 1), _FACTOR_INVERSE if inverse else _FACTOR)
        base[0] = 1
        have = np.multiply.accumulate(base)
        if n <= 8 * SLICE_BYTES:
            _powers[key] = have
    return have[:n]


# A stretch of bytes beyond this many is hashed by a digest of its own.
LONG_STRETCH = 1024
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each stretch of bytes.

    Eight bytes after the other go into the hash through ``mix``. A linear sum over
    the bytes, as a polynomial modulo 2^64, is equal for some long regular texts.
    """
    left = ends - starts
    out = left.astype(np.uint64) * _FACTOR
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    long = np.flatnonzero(left > LONG_STRETCH)
    rows = np.flatnonzero(left <= LONG_STRETCH) if len(long) else None
    at, left = (starts, left) if rows is None else (starts[rows], left[rows])
    h = out if rows is None else out[rows]
    whole = h
    now = slice(None)
    while len(at):
        h = mix((h ^ (wide[at] & _KEEP[np.minimum(left, 8)])) + _FACTOR)
        whole[now] = h
        more = np.flatnonzero(left > 8)
        at, left, h = at[more] + 8, left[more] - 8, h[more]
        now = more if isinstance(now, slice) else now[more]
    if rows is not None:
        out[rows] = whole
        view = memoryview(padded)
        for i in long.tolist():
            out[i] = int.from_bytes(blake2b(view[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


class Words:
    """Where the words of each row lie, with one 64-bit hash per word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray = SPACES, lower: bool = True):
        self.data, self.offsets = data, offsets
        inside = ~ends_word[LOWER[data] if lower else data]
        padded = np.zeros(len(data) + 2, dtype=bool)
        padded[1:-1] = inside
        first = inside & ~padded[:-2]
        last = inside & ~padded[2:]
        # a row's first byte starts a word, and its last byte ends one
        starts_row = offsets[:-1][np.diff(offsets) > 0]
        first[starts_row] = inside[starts_row]
        ends_row = offsets[1:][np.diff(offsets) > 0] - 1
        last[ends_row] = inside[ends_row]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self._lower = lower

    def hashes(self) -> np.ndarray:
        return stretch_hashes(LOWER[self.data] if self._lower else self.data, self.starts, self.ends)


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a row, and the row bounds in them.

    ``short``: a row with fewer words, but one at least, counts as one run.
    """
    counts = np.diff(bounds)
    runs = np.maximum(counts - size + 1, 0)
    few = (counts < size) & (counts > 0)
    if short:
        runs = np.where(few, 1, runs)
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    row = np.repeat(np.arange(len(counts)), runs)
    at = bounds[:-1][row] + (np.arange(out_bounds[-1]) - out_bounds[:-1][row])
    out = np.zeros(len(at), np.uint64)
    stop = bounds[1:][row]
    for k in range(size):
        where = at + k
        there = where < stop if short and few.any() else slice(None)
        factor = np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
        if isinstance(there, slice):
            out += hashes[where] * factor
        else:
            out[there] += hashes[where[there]] * factor
    return mix(out), out_bounds


def columns(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values.values()], names=list(values))
