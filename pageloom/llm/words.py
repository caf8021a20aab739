"""Word hashes of whole Arrow batches in a few numpy passes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; words that cross the mark stay whole. A worker keeps 16 times as much, and needs as much again.
BLOCK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_FOLDED = _BYTES.copy()
_FOLDED[0x41:0x5B] = _BYTES[0x61:0x7B]
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers of the base and of its inverse, modulo 2**64."""
    one = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.concatenate([one, np.full(n - 1, x, np.uint64)])) for x in (_BASE, _BACK))


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text each, one row at least."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), np.int64)
    run = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, one text after the other, and the offsets of the texts; a null is empty."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans come in order and do not overlap."""
    values = _FOLDED if fold else _BYTES
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + BLOCK, "right")))
        low, high = int(starts[a]), int(ends[b - 1])
        power, back = _powers(max(BLOCK, high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * power[: high - low], out=sums[1:])
        s, e = starts[a:b] - low, ends[a:b] - low
        # every word is brought back to power 0, so that its place does not count
        out[a:b] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))
        a = b
    return out


def word_hashes(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: a 64-bit hash of every word, text after text, and each text's number of words.

    A word is a run of bytes other than ASCII white space; ``fold`` takes A-Z for a-z."""
    data, offsets = text_bytes(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(column), np.int64)
    solid = ~_SPACE[data]
    first = np.empty(n, bool)
    first[0] = True
    np.logical_not(solid[:-1], out=first[1:])
    inner = offsets[:-1][offsets[:-1] < n]
    first[inner] = True
    first &= solid
    last = np.empty(n, bool)
    last[-1] = True
    np.logical_not(solid[1:], out=last[:-1])
    last[inner[inner > 0] - 1] = True
    last &= solid
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    out = span_hashes(data, starts, ends, fold)
    return out, counts


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``size`` consecutive words, across text bounds too: callers leave those out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step = _STEP + np.uint64(2 * seed)
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= step
        out += hashes[i : i + n]
    return mix(out + np.uint64(seed))


def places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word its text's row and its place in the text."""
    rows = np.repeat(np.arange(len(counts)), counts)
    begins = np.cumsum(counts) - counts
    return rows, np.arange(len(rows)) - begins[rows]
