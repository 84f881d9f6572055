"""Words, lines and their hashes for whole batches of texts, as flat numpy arrays.

A batch of texts is one run of UTF-8 bytes. Words end at the bytes 0x20 and
0x09-0x0D, which never lie inside a longer character, so no text is decoded.
The hash of any stretch of bytes comes from one running sum: with a random
number for every byte value and an odd base B, ``sum(R[byte_i] * B**i)`` over
the stretch, times ``B**-start``, does not depend on where the stretch lies.
Two different stretches share a 64-bit hash with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Texts are worked through in runs of about so many bytes (one text at least). A run
# takes up to a hundred bytes of arrays for each of its own.
SLICE_BYTES = 1 << 18

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20_240_517).integers(1, 1 << 63, 256, np.uint64) * np.uint64(
    2
) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base**0 ... base**(size-1), modulo 2**64; kept for later batches."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Slice:
    """Some neighbouring texts of a batch: texts ``first`` up to ``last``."""

    first: int
    last: int
    data: np.ndarray  # bytes of these texts
    offsets: np.ndarray  # of each text in data, and the end

    def __len__(self) -> int:
        return self.last - self.first

    def sums(self, lower: bool = False) -> np.ndarray:
        """Running sum for ``hashes``; ``lower`` takes A-Z as a-z."""
        data = _LOWER[self.data] if lower else self.data
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_RANDOM[data] * _power(_BASE, len(data)), out=out[1:])
        return out

    def words(self) -> Words:
        """All words, in order."""
        space = SPACES[self.data]
        edge = np.ones(len(self.data) + 1, bool)
        edge[1:-1] = space[:-1]
        edge[self.offsets] = True
        starts = np.flatnonzero(edge[:-1] & ~space)
        edge[:-1] = space
        edge[-1] = True
        edge[self.offsets] = True
        stops = np.flatnonzero(edge)
        ends = stops[np.searchsorted(stops, starts, "right")]
        text = np.searchsorted(self.offsets, starts, "right") - 1
        return Words(starts, ends, text, np.bincount(text, minlength=len(self)))


@dataclass
class Words:
    """Byte ranges of words, the text of each, and the number by text."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def firsts(self) -> np.ndarray:
        """Index of the first word of each text."""
        return np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64)


def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes."""
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts])


def grams(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` neighbouring words from each word on, where there are as many."""
    count = max(0, len(hashed) - size + 1)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * np.uint64(_BASE) + hashed[i : i + count]
    return mix(out)


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """A column of texts in runs of about ``most`` bytes; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    count = len(column)
    if not count:
        return
    buffers = column.buffers()
    ends = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + count + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        last = int(np.searchsorted(ends, ends[first] + most, "right")) - 1
        last = min(max(last, first + 1), count)
        yield Slice(first, last, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last
