"""Nearest vectors by randomly rotated one-bit codes.

Every vector is scaled to length one, centred on one of CENTRES directions (k-means on at
most SAMPLE vectors, a documented bound; only the codes' sharpness depends on it), turned by a
random rotation and kept as the sign bits of its coordinates plus two numbers: its distance to
the centre and the inner product of the turned residual with its own code. From packed bits
and these numbers the inner product with a query is estimated without bias, and an upper bound
is SPREAD standard deviations above the estimate (too low for about one pair in 120). Inside a block
of vectors the k best estimates are scored exactly, on the original vectors in double precision;
then every vector whose upper bound reaches the k-th of these scores. Each block hands on its k
best, which are merged per query.

Queries and vectors meet block by block: vectors lie in blocks of BLOCK rows, queries in blocks
of QUERIES rows, and every pair of blocks is one row of a shuffle, so a task holds two blocks
at any size of the table. The k nearest of a query are combined by partial aggregation.

Defined results: vectors that are null, empty, zero, of another length than the most frequent
one, or hold null or non-finite components take no part. Ties go to the smaller vec_id. Rows
that repeat a vec_id are vectors of their own, but a query's own id is never its neighbour, and
a repeated query id asks once, with its smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe.llm.store import written

SAMPLE = 5000
CENTRES = 32
BLOCK = 2048
QUERIES = 1024
SPREAD = 2.4


def usable(vectors: DataFrame) -> DataFrame:
    """row, vec_id and embedding (doubles) of the vectors that take part."""
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.filter(fine)


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    top = np.abs(flat).max(axis=1, keepdims=True)  # first, so that no square overflows or vanishes
    flat = flat / top
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


class Coder:
    """A rotation and centres; codes of vectors and estimates of their inner products with queries."""

    def __init__(self, units: np.ndarray, seed: int = 5):
        draw = np.random.default_rng(seed)
        width = units.shape[1]
        self.turn = np.linalg.qr(draw.normal(size=(width, width)))[0]
        count = min(CENTRES, max(1, len(units) // 20))
        centres = units[draw.choice(len(units), count, replace=False)]
        for _ in range(8):
            near = (units @ centres.T).argmax(axis=1)
            for k in range(count):
                if (mine := units[near == k]).size:
                    centres[k] = mine.mean(axis=0)
        self.centres = centres

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, ...]:
        """Centre, packed sign bits, distance to the centre, and <residual, code> of unit vectors."""
        near = (units @ self.centres.T).argmax(axis=1)
        residual = (units - self.centres[near]) @ self.turn
        distance = np.sqrt((residual * residual).sum(axis=1))
        residual /= np.maximum(distance, 1e-300)[:, None]
        width = units.shape[1]
        return near, np.packbits(residual > 0, axis=1), distance, np.abs(residual).sum(axis=1) / np.sqrt(width)

    def estimates(self, code: tuple[np.ndarray, ...], query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimates and upper bounds of the inner products of coded vectors (rows) with queries (columns)."""
        near, bits, distance, own = code
        width = query.shape[1]
        turned = query @ self.turn
        signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32) * 2 - 1
        guess = (signs @ turned.T.astype(np.float32)).astype(np.float64) / np.sqrt(width) / np.maximum(own, 1e-12)[:, None]
        centre = (self.centres @ query.T)[near]
        # the part of a query that a code cannot see is spread evenly over width - 1 directions
        size = np.sqrt((turned * turned).sum(axis=1))
        miss = SPREAD * np.sqrt(np.maximum(1 - own * own, 0)) / np.maximum(own, 1e-12) / np.sqrt(max(width - 1, 1))
        slack = distance[:, None] * miss[:, None] * size[None, :] + 1e-5
        middle = centre + distance[:, None] * guess
        return middle, middle + slack


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest other vectors of every query."""
    spark = vectors.sparkSession
    rows = written(usable(vectors), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    shape = "query_id long, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = int(sizes["n"]), int(sizes["rows"])
    rows = rows.filter(F.size("v") == width)
    share = min(1.0, SAMPLE / total)
    lucky = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = rows.filter(lucky).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()["v"]
    sample = sample.combine_chunks() if len(sample) else rows.limit(1).select("v").toArrow()["v"].combine_chunks()
    coder = Coder(unit_rows(sample, width))

    def blocks_of(many: int, size: int) -> int:
        return max(1, -(-many // size))

    def packed(part: DataFrame, size: int, many: int, name: str) -> DataFrame:
        """Blocks of about ``size`` rows at most: block number, and ids with vectors."""
        spot = F.pmod(F.xxhash64("row"), F.lit(blocks_of(many, size)))
        return part.groupBy(spot.alias(name)).agg(F.collect_list(F.struct("vec_id", "v")).alias(f"{name}_rows"))

    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.min("row").alias("row"))
    asked = written(asked, "queries")
    many = asked.count()
    queries = written(packed(asked, QUERIES, many, "q"), "query-blocks")
    blocks = written(packed(rows, BLOCK, total, "b"), "vector-blocks")
    # every block number with every query block number; only then the blocks themselves
    grid = blocks.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks_of(many, QUERIES) - 1).cast("long"))).alias("q"))
    pairs = grid.join(queries, "q").join(blocks, "b") \
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("b", "q")).select("q_rows", "b_rows")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                sides = []
                for side in (0, 1):
                    structs = batch.column(side).slice(row, 1).flatten()
                    ids, lists = structs.flatten()
                    sides.append((ids.to_numpy(), unit_rows(lists, width)))
                (ask, query), (ids, units) = sides
                code = coder.encode(units)
                out = []
                for first in range(0, len(ask), 256):
                    guess, high = coder.estimates(code, query[first: first + 256])
                    own = ids[:, None] == ask[None, first: first + 256]
                    guess[own], high[own] = -np.inf, -np.inf
                    least = np.full(guess.shape[1], -np.inf)
                    if len(ids) > k:
                        top = np.argpartition(-guess, k - 1, axis=0)[:k]
                        scores = np.einsum("kqj,qj->kq", units[top], query[first: first + 256])
                        scores[np.take_along_axis(own, top, axis=0)] = -np.inf
                        least = scores.min(axis=0) - 1e-12
                    which, column = np.nonzero((high >= least[None, :]) & ~own)
                    exact = np.einsum("ij,ij->i", units[which], query[first + column])
                    order = np.lexsort((ids[which], -exact, column))
                    which, column, exact = which[order], column[order], exact[order]
                    place = np.arange(len(column)) - np.searchsorted(column, column, "left")
                    best = place < k
                    out.append((ask[first + column[best]], ids[which[best]], exact[best]))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in zip(*out)], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, shape)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
