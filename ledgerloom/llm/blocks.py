"""Texts of an Arrow batch as one run of bytes, with words found and hashed for all of them at once.

A task works on blocks of a few megabytes: the UTF-8 bytes of several texts in one numpy
array.  Words are runs of bytes that a 256-entry table calls word bytes, so no Python loop
runs over characters or words.  Both word classes used here treat every byte from 0x80 as
part of a word, hence bytes and code points cut a text at the same places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words are what stands between spaces, tabs and line ends.
SPACED = ~_SPACE
#: Words of letters, digits and every byte beyond ASCII (texts are in lower case by then).
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _RANDOM.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, BLOCK_BYTES), base, np.uint64)
        known[0] = 1
        _POWERS[base] = known = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class RollingHash:
    """Hashes of any stretches of one byte array, from one pass over it."""

    def __init__(self, data: np.ndarray):
        terms = _BYTE_VALUE[data] * _powers(_BASE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * _powers(_INVERSE, len(self.sums))[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def windows_hash(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k : n + k] * _STEP[k]
    return mix(total)


@dataclass
class Block:
    """Texts number ``first`` to ``first + n`` of a batch; ``bounds`` are their byte limits in ``data``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """The words of a block: byte limits, hashes, and the words of text ``i`` at ``cuts[i]:cuts[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray

    @cached_property
    def hashes(self) -> np.ndarray:
        return RollingHash(self.data).of(self.starts, self.ends)

    @cached_property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of at most ``limit`` bytes, or one longer text; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Block(first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


def find_words(block: Block, kind: np.ndarray, lower: bool = True) -> Words:
    """The words of every text; no word spans two texts."""
    data = LOWER[block.data] if lower else block.data
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    inner = block.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    cut = inner[inside[inner] & inside[inner + 1]]
    begins[cut] = True
    stops[cut] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return Words(data, starts, ends, np.searchsorted(starts, block.bounds))


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte limit."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total


def per_text(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the stretches between ``cuts``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[cuts[1:]] - total[cuts[:-1]]
