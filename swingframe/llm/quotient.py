"""Counting quotient filters of packed n-grams.

An n-gram of word ids is a key of two halves, packed without gaps. A Feistel network permutes it within
its own bits, so keys are spread evenly and nothing is lost: the top bits of a permuted key, its
quotient, name a slot, and all the other bits are its remainder. A filter holds its keys in
order: how many remainders each slot has, the remainders, and a count for each, as planes of as many
bytes as the largest value takes. It is cut by the first bits of the quotient into segments; filters of one
segment from many shards are merged by order, adding counts, and permuting back gives the n-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from swingframe.llm.words import mix, step

TURNS = 4
CODEC = "zstd"


def planes(values: np.ndarray) -> list[bytes]:
    """A byte of width, then the values' bytes, plane by plane; zero takes none."""
    width = -(-int(values.max(initial=0)).bit_length() // 8)
    spread = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return [bytes([width]), np.ascontiguousarray(spread.T).tobytes()]


def from_planes(blob: memoryview, at: int, count: int) -> tuple[np.ndarray, int]:
    width = blob[at]
    out = np.zeros((count, 8), np.uint8)
    end = at + 1 + width * count
    out[:, :width] = np.frombuffer(blob[at + 1: end], np.uint8).reshape(width, count).T
    return out.view("<u8").ravel().astype(np.uint64), end


def squeezed(parts: list[bytes]) -> bytes:
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=CODEC, asbytes=True)


def unsqueezed(blob: bytes) -> memoryview:
    size = int.from_bytes(blob[:8], "little")
    return memoryview(pa.decompress(blob[8:], decompressed_size=size, codec=CODEC, asbytes=True))


@dataclass(frozen=True)
class Shape:
    """Keys of ``order`` ids of ``bits`` bits each (32 at most); 2**cut segments at most."""

    order: int
    bits: int
    cut: int

    @property
    def left(self) -> int:
        return self.order // 2 * self.bits

    @property
    def right(self) -> int:
        return (self.order - self.order // 2) * self.bits

    @property
    def segment_bits(self) -> int:
        return min(self.cut, self.left)

    def packed(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        halves = []
        for part in (ids[: self.order // 2], ids[self.order // 2:]):
            half = part[0].astype(np.uint64)
            for x in part[1:]:
                half = (half << np.uint64(self.bits)) | x.astype(np.uint64)
            halves.append(half)
        return halves[0], halves[1]

    def unpacked(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        mask, out = np.uint64((1 << self.bits) - 1), []
        for half, count in ((left, self.order // 2), (right, self.order - self.order // 2)):
            out += [(half >> np.uint64(self.bits * k)) & mask for k in reversed(range(count))]
        return out

    def permuted(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.uint64((1 << self.left) - 1), np.uint64((1 << self.right) - 1)
        for turn in range(TURNS):
            left = left ^ (mix(right + step(2 * turn + 1)) & low)
            right = right ^ (mix(left + step(2 * turn + 2)) & high)
        return left, right

    def restored(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.uint64((1 << self.left) - 1), np.uint64((1 << self.right) - 1)
        for turn in reversed(range(TURNS)):
            right = right ^ (mix(left + step(2 * turn + 2)) & high)
            left = left ^ (mix(right + step(2 * turn + 1)) & low)
        return left, right

    def summed(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys in order, each once, with the sum of its counts (each 1 where none are given)."""
        if not len(left):
            return left, right, np.zeros(0, np.int64)
        if self.left + self.right <= 64:
            whole = (left << np.uint64(self.right)) | right
            if counts is None:
                whole = np.sort(whole)
            else:
                order = np.argsort(whole, kind="stable")
                whole, counts = whole[order], counts[order]
            left, right = whole >> np.uint64(self.right), whole & np.uint64((1 << self.right) - 1)
        else:
            order = np.lexsort((right, left))
            left, right = left[order], right[order]
            counts = None if counts is None else counts[order]
        first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
        total = np.diff(np.append(first, len(left))) if counts is None else np.add.reduceat(counts, first)
        return left[first], right[first], total

    def segments(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, bytes]]:
        """(segment, quotient bits, keys, filter) of keys in order."""
        taken = self.segment_bits
        quotient = min(self.left, max(taken, int(len(left)).bit_length()))
        bounds = np.searchsorted(left, np.arange(1 << taken, dtype=np.uint64) << np.uint64(self.left - taken))
        out = []
        for segment, (a, b) in enumerate(zip(bounds.tolist(), [*bounds[1:].tolist(), len(left)])):
            if a < b:
                slot = (left[a:b] >> np.uint64(self.left - quotient)) & np.uint64((1 << (quotient - taken)) - 1)
                held = np.bincount(slot.astype(np.int64), minlength=1 << (quotient - taken))
                rest = left[a:b] & np.uint64((1 << (self.left - quotient)) - 1)
                out.append((segment, quotient, b - a, squeezed([*planes(held), *planes(counts[a:b]), *planes(rest), *planes(right[a:b])])))
        return out

    def read(self, segment: int, quotient: int, keys: int, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The permuted keys and counts of one filter."""
        taken, raw = self.segment_bits, unsqueezed(blob)
        held, at = from_planes(raw, 0, 1 << (quotient - taken))
        counts, at = from_planes(raw, at, keys)
        rest, at = from_planes(raw, at, keys)
        right, _ = from_planes(raw, at, keys)
        slot = np.repeat(np.arange(len(held), dtype=np.uint64), held.astype(np.int64))
        top = (np.uint64(segment) << np.uint64(quotient - taken)) | slot
        return (top << np.uint64(self.left - quotient)) | rest, right, counts.astype(np.int64)

    def merged(self, segment: int, filters: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One segment's filters (quotient bits, keys, filter) as one run of keys and counts."""
        parts = [self.read(segment, *f) for f in filters]
        return self.summed(*(np.concatenate([p[k] for p in parts]) for k in range(3)))
