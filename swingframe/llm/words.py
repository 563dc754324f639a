"""Words of many texts at once, as spans of one byte buffer.

Arrow keeps the texts of a batch in one UTF-8 buffer. Word borders, word hashes
and hashes of any other span are read from it by a few numpy passes, so no step
runs Python code for each word. ``pieces`` cuts a batch into pieces of bounded
bytes; only a single text longer than that makes a larger piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
PIECE_ROWS = 1 << 15
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def step(turn: int) -> np.uint64:
    """The turn-th of a series of well spread 64-bit constants."""
    return np.uint64(turn * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF)


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below size, by doubling."""
    tables = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        out, step = np.ones(1, np.uint64), base
        while len(out) < size:
            out, step = np.concatenate([out, out * np.uint64(step)]), step * step % (1 << 64)
        tables.append(out[:size])
    return tables[0], tables[1]


class SpanHasher:
    """Hashes of spans of a byte buffer from one running sum."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(16, int(len(data) + 1).bit_length())
        power, self.inverse = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * power[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of at most ``most`` bytes
    where no row alone exceeds it; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, first + PIECE_ROWS, len(column))
        yield first, last, data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of marked bytes; no run crosses a text border."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.zeros(len(inside) + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~cut[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~cut[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, text_of(starts, offsets)


def text_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, positions, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every blank-separated word, with A-Z lowered."""
    starts, ends, owner = runs(~SPACE[data], offsets)
    return SpanHasher(LOWERED[data])(starts, ends), owner


def sums_by(owner: np.ndarray, values: np.ndarray | None, count: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=count)
