"""Words and shingles of whole Arrow columns as numpy arrays, without a Python object for each word.

A word is a maximal run of bytes outside 0x09-0x0D and 0x20, with A-Z lower-cased,
so on UTF-8 it is the same as `[^\\x20\\x09-\\x0D]+` on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
GAP = np.zeros(256, bool)
GAP[9:14] = GAP[32] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = pow(0x9E3779B97F4A7C15, 3, 1 << 64)
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
BYTE_LOWER = BYTE[LOWER]


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=U64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about `most` bytes of text; a longer text is a run of its own."""
    sizes = batch.column(column).cast(pa.large_string()).fill_null("")
    at = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1] if len(sizes) else np.zeros(1, np.int64)
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word."""
    gap = GAP[data]
    first = ~gap
    last = ~gap
    if len(data):
        first[1:] &= gap[:-1]
        last[:-1] &= gap[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        first[cut] = ~gap[cut]
        last[cut - 1] = ~gap[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans: polynomial prefix sums moved back to the span's start, then mixed."""
    n = len(values)
    sums = np.zeros(n + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(values * powers(BASE, n), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(U64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each lower-cased word."""
    starts, ends, rows = word_spans(data, offsets)
    return span_hashes(BYTE_LOWER[data], starts, ends), rows


TURN = [U64(pow(0xD6E8FEB86659FD93, 2 * k + 1, 1 << 64)) for k in range(64)]


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row's k-word shingles, and the n + 1 offsets; fewer words make one shingle, none make none."""
    hashes, rows = word_hashes(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    with np.errstate(over="ignore"):
        whole = max(len(hashes) - k + 1, 0)
        sums = np.zeros(whole, U64)
        for j in range(k):
            sums += hashes[j : j + whole] * TURN[j]
        full = np.flatnonzero(rows[:whole] == rows[k - 1 :]) if whole else np.zeros(0, np.int64)
        made, owner = mix(sums[full]), rows[full]
        for length in range(1, k):
            short = np.flatnonzero(counts == length)
            total = np.full(len(short), length, U64) * TURN[k + 1]
            for j in range(length):
                total += hashes[firsts[short] + j] * TURN[j]
            made, owner = np.concatenate([made, mix(total ^ TURN[k])]), np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable") if len(owner) and np.any(owner[1:] < owner[:-1]) else slice(None)
    made, owner = made[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    sets = [np.unique(made[bounds[i] : bounds[i + 1]]) for i in range(n)]
    return (np.concatenate(sets) if sets else made), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
