"""Words and word hashes of whole Arrow text columns, as numpy arrays.

A block is a run of whole texts. Words are hashed with a polynomial over random byte values
modulo 2**64; equal words have equal hashes, and unequal words agree with a chance of about
2**-64, as for any 64-bit fingerprint.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Words end at ASCII white space: space and 0x09 to 0x0D.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

# Words are runs of digits, lower-case letters and everything outside ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest stretch so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def gives_back(run: Callable) -> Callable:
    """A function over batches that returns freed memory to the system at its end.

    Spark keeps Python workers for later tasks; without this each would keep its peak.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


@dataclass
class Words:
    """Words of a block in order. ``first[i]:first[i + 1]`` are the words of text ``i``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(low, high, bytes, offsets)`` of runs of whole texts of about ``size`` bytes; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def words(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray, lower: bool = True) -> Words:
    """The words of a block: longest runs of bytes of the alphabet within one text."""
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = alphabet[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    before[filled] = False
    after[filled[1:] - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~before)
    ends = np.flatnonzero(inside[1:-1] & ~after) + 1
    return Words(starts, ends, byte_hashes(data, starts, ends), np.searchsorted(starts, offsets))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches ``data[starts[i]:ends[i]]``, which follow each other."""
    out = np.empty(len(starts), dtype=np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + BLOCK_BYTES, side="right")))
        begin = starts[low]
        up, down = _POWERS.upto(int(ends[high - 1] - begin))
        sums = np.zeros(len(up) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data[begin : ends[high - 1]]] * up, out=sums[1:])
        s, e = starts[low:high] - begin, ends[low:high] - begin
        out[low:high] = mix((sums[e] - sums[s]) * down[s])
        low = high
    return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words, text borders not regarded."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        total += hashes[j : j + n] * U(2 * pow(3, 2 * j + 1) + 1)
    return mix(total)


def shingle_sets(found: Words, size: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingles; a text of fewer words has one shingle, of all its words."""
    every = windows(found.hashes, size)
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(every[low : high - size + 1])
        else:
            yield windows(found.hashes[low:high], high - low) if high > low else np.empty(0, dtype=np.uint64)
