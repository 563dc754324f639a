"""Blocked Bloom filters that Spark builds and tasks probe with numpy.

A key is a 64-bit hash. Its upper half names a block of eight 64-bit lanes, and a second hash sets
one bit in each lane, so a probe reads one cache line and most misses end at its first lane.
A filter can be cut into shards (here: lengths), each with blocks of its own. At KEYS_IN_BLOCK
keys a block about one miss in 2,000 passes; what passes is only a candidate.

The bytes of a filter follow from the numbers of blocks, which the caller bounds before building.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe.llm.words import GOLDEN, mix

LANES = 8
KEYS_IN_BLOCK = 32
BLOCK_BYTES = 8 * LANES


def lanes_of(keys: np.ndarray) -> np.ndarray:
    return mix(keys + GOLDEN)


def lane_bit(second: np.ndarray, lane: int) -> np.ndarray:
    return (second >> np.uint64(8 * lane)) & np.uint64(63)


def block_of(keys: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.asarray(blocks, np.uint64) >> np.uint64(32)).astype(np.int64)


def blocks_for(keys: int) -> int:
    return max(1, -(-keys // KEYS_IN_BLOCK))


class Filter:
    """blocks: number of blocks of every shard; the shards' blocks follow one another."""

    def __init__(self, blocks: dict[int, int]):
        self.blocks = blocks
        ends = np.cumsum(list(blocks.values())).tolist()
        self.first = dict(zip(blocks, [0, *ends[:-1]]))
        self.lanes = np.zeros((ends[-1] if ends else 0, LANES), np.uint64)

    def holds(self, shard: int, keys: np.ndarray) -> np.ndarray:
        """Positions, in ``keys``, of those that may be in a shard."""
        if shard not in self.blocks or not len(keys):
            return np.zeros(0, np.int64)
        at, second = self.first[shard] + block_of(keys, self.blocks[shard]), lanes_of(keys)
        left = np.flatnonzero((self.lanes[at, 0] >> lane_bit(second, 0)) & np.uint64(1))
        for lane in range(1, LANES):
            left = left[((self.lanes[at[left], lane] >> lane_bit(second[left], lane)) & np.uint64(1)).astype(bool)]
        return left


def built(rows: DataFrame, blocks: dict[int, int], keyed: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]]) -> Filter:
    """The filter of all keys of a table; ``keyed`` gives the shards and keys of a batch.

    Blocks are combined by Spark (bit_or, partly before the shuffle); the driver reads one
    row of 64 bytes for each block."""
    made = Filter(blocks)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, keys in keyed(batch):
                second = lanes_of(keys)
                at = made.first[shard] + block_of(keys, blocks[shard])
                lanes = [pa.array((np.uint64(1) << lane_bit(second, k)).view(np.int64)) for k in range(LANES)]
                yield pa.RecordBatch.from_arrays([pa.array(at), *lanes], names=["at", *names])

    names = [f"lane{k}" for k in range(LANES)]
    parts = rows.mapInArrow(bits, "at long, " + ", ".join(f"{x} long" for x in names))
    full = parts.groupBy("at").agg(*(F.bit_or(x).alias(x) for x in names)).toArrow()
    out = Filter(blocks)
    at = full["at"].to_numpy()
    for k, x in enumerate(names):
        out.lanes[at, k] = full[x].to_numpy().view(np.uint64)
    return out
