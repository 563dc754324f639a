"""Near duplicates by SimHash and pivot distance tables.

A text's words (blank-separated, A-Z lowered) give shingles of WORDS words, repeats included, joined by
single spaces (fewer words: the whole sequence). Each shingle has its XXH64 (seed 42); a bit of the
fingerprint is set if it is set in over half of them. A text without words has fingerprint zero.

Different fingerprints that differ in at most REACH bits are linked, and a link's ends are one component.
The distances of every fingerprint to REFERENCES reference fingerprints (rows of a Walsh matrix, which
are 32 bits apart) are computed once and packed a byte each. By the triangle inequality the distances of
two linked fingerprints to any reference differ by at most REACH, so a pair with a larger difference in
any coordinate is discarded, and only the survivors are verified on all 64 bits.

Pairs come from places: fingerprints are cut into blocks, REACH of which cannot hide a difference from the
others, so linked fingerprints agree in (blocks - REACH) whole blocks, and meet in the place named by the first
of them. The number of blocks grows with the number of fingerprints, so places stay small where fingerprints
are spread. A place is not expanded into pairs: in rounds, a growing share of its members (all, if
there are ALL_AT_ONCE at most) is compared with the members that are not connected to them yet, until the
place is one component or every member has been compared with every other component. Neither a link
is lost, nor is a group of many copies paired within itself. What is left is a place that many different
fingerprints share without being linked: its comparisons are the square of its members in the end, each a few
instructions of generated code.

Defined results: null counts as empty. component_id is the smallest doc_id that can be reached; a null
doc_id ranks last, so it is null only where all are. Equal texts, repeated rows and ties have equal fingerprints and
one component. A text of any length is taken whole, in slices. An empty table gives no rows. Only doc_id
and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swingframe.llm.graph import components
from swingframe.llm.store import written
from swingframe.llm.words import LOWERED, SPACE, pieces, runs, sums_by

WORDS = 4
SEED = 42
BITS = 64
REACH = 4
REFERENCES = 16
FEWEST_BLOCKS = REACH + 2
PAIRS_EXPECTED = 64  # comparisons of a spread fingerprint, beyond which more blocks are cut
ALL_AT_ONCE = 16
GROWTH = 16
SLICE = 1 << 17  # shingles whose bits are counted at once


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 and text of every shingle; each text's words are laid out with single spaces first."""
    starts, ends, owner = runs(~SPACE[data], offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    kept = inside.copy()
    kept[1:] |= inside[:-1]  # the blank behind each word
    laid = np.where(inside, LOWERED[data], 0x20)[kept].astype(np.uint8)
    place = np.cumsum(kept)
    begin, end = place[starts] - 1, place[ends - 1]
    texts = len(offsets) - 1
    count = sums_by(owner, None, texts)
    left = (np.cumsum(count))[owner] - np.arange(len(starts))  # words from here to the text's end
    heads = np.flatnonzero((left >= WORDS) | ((count[owner] < WORDS) & (left == count[owner])))
    tails = np.minimum(heads + WORDS, np.cumsum(count)[owner[heads]]) - 1
    buffer, digest = laid.tobytes(), xxhash.xxh64_intdigest
    spans = zip(begin[heads].tolist(), end[tails].tolist())
    return np.fromiter((digest(buffer[a:b], SEED) for a, b in spans), np.uint64, len(heads)), owner[heads]


def majority(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The bits that are set in over half of each text's hashes."""
    ones = np.zeros((texts, BITS), np.int64)
    for at in range(0, len(hashes), SLICE):
        whose = owner[at: at + SLICE]
        bits = np.unpackbits(hashes[at: at + SLICE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
        ones[whose[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    over = 2 * ones > sums_by(owner, None, texts)[:, None]
    return np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text in; doc_id, fp out."""
    for batch in batches:
        for first, last, data, offsets in pieces(batch.column(1)):
            made = majority(*shingle_hashes(data, offsets), last - first)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(made.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint as a long of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(fingerprint_rows, f"doc_id {kind}, fp long")


def signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def walsh(row: int) -> int:
    """64 bits, of which bit j is the parity of row AND j."""
    return sum(((row & j).bit_count() & 1) << j for j in range(BITS))


def distances(fp: str) -> list[Column]:
    """Distances to the references, packed eight to a long."""
    each = [F.bit_count(F.col(fp).bitwiseXOR(F.lit(signed(walsh(k + 1))))).cast("long") for k in range(REFERENCES)]
    packed = []
    for at in range(0, REFERENCES, 8):
        column = each[at]
        for k in range(1, 8):
            column = column.bitwiseOR(F.shiftleft(each[at + k], 8 * k))
        packed.append(column.alias(f"t{at // 8}"))
    return packed


def within(x: str, y: str) -> Column:
    """No coordinate of the two tables differs by more than REACH."""
    held = None
    for k in range(REFERENCES):
        a, b = (F.shiftrightunsigned(F.col(f"{side}{k // 8}"), 8 * (k % 8)).bitwiseAND(F.lit(255).cast("long")) for side in (x, y))
        near = F.abs(a - b) <= REACH
        held = near if held is None else held & near
    return held


def blocks_for(count: int) -> int:
    """Blocks to cut, so that a fingerprint among ``count`` spread ones meets few others."""
    blocks = FEWEST_BLOCKS
    while blocks < BITS // 4 and comb(blocks, REACH) * count / 2 ** (BITS * (blocks - REACH) / blocks) > PAIRS_EXPECTED:
        blocks += 1
    return blocks


class Places:
    """Masks of the blocks, and of the places that (blocks - REACH) agreeing blocks name."""

    def __init__(self, blocks: int):
        cuts = [BITS * k // blocks for k in range(blocks + 1)]
        self.masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
        self.chosen = list(combinations(range(blocks), blocks - REACH))

    def rows(self, fp: str) -> Column:
        """An array of (place, wanted, below): the place's name; the blocks that it takes, and all up to the last of them, as bits."""
        def of(at: int) -> Column:
            chosen = self.chosen[at]
            mask = sum(self.masks[k] for k in chosen)
            return F.struct(
                F.xxhash64(F.lit(at), F.col(fp).bitwiseAND(F.lit(signed(mask)))).alias("place"),
                F.lit(sum(1 << k for k in chosen)).alias("wanted"), F.lit((2 << chosen[-1]) - 1).alias("below"))

        return F.array(*(of(k) for k in range(len(self.chosen))))

    def agreeing(self, x: str, y: str) -> Column:
        """The blocks in which two fingerprints agree, as bits."""
        both = F.col(x).bitwiseXOR(F.col(y))
        return sum((F.when(both.bitwiseAND(F.lit(signed(m))) == 0, 1 << k).otherwise(0) for k, m in enumerate(self.masks)), F.lit(0))


def connected(nodes: DataFrame) -> DataFrame:
    """(fp, component) of the different fingerprints that are linked to another; nodes: fp, each once."""
    places = Places(blocks_for(nodes.count()))
    members = nodes.select("fp", F.explode(places.rows("fp")).alias("p"), F.pmod(F.xxhash64("fp"), F.lit(1 << 52)).alias("luck"))
    members = members.select("fp", "p.place", "p.wanted", "p.below", "luck")
    shared = members.groupBy("place").agg(F.count("*").alias("size"), F.min("luck").alias("best")).filter("size > 1")
    # a merge join: both sides have rows for every place, but Spark sizes them as ``nodes``, as if not exploded, and would broadcast one
    members = written(members.join(shared.hint("merge"), "place"), "simhash-members")
    component, reach = None, 1
    while True:
        if component is None:
            state = members.withColumn("component", F.col("fp"))
        else:
            state = members.join(component, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
            unsettled = state.groupBy("place").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
            state = state.join(unsettled.select("place"), "place")

        def pivot(reach: int) -> Column:
            share = F.col("luck") / F.lit(float(1 << 52)) * F.col("size") < float(reach)
            return (F.col("size") <= ALL_AT_ONCE) | (F.col("luck") == F.col("best")) | share

        old = F.lit(False) if reach == 1 else pivot(reach // GROWTH)
        state = written(state.withColumns({"now": pivot(reach), "old": old}), "simhash-state")
        most = state.agg(F.max("size")).first()[0]
        if most is None:
            break
        side = state.filter("NOT old")
        a = side.filter("now").select("place", F.col("fp").alias("x"), F.col("component").alias("u"), "wanted", "below", *distances("fp"))
        a = a.withColumnsRenamed({f"t{k}": f"xt{k}" for k in range(REFERENCES // 8)})
        b = side.select("place", F.col("fp").alias("y"), F.col("component").alias("v"), "now", *distances("fp"))
        b = b.withColumnsRenamed({f"t{k}": f"yt{k}" for k in range(REFERENCES // 8)})
        first = places.agreeing("x", "y").bitwiseAND(F.col("below")) == F.col("wanted")
        linked = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= REACH
        pairs = a.join(b, "place").filter(F.expr("u <> v AND (NOT now OR x < y)") & within("xt", "yt") & linked & first)
        links = written(pairs.select("u", "v"), "simhash-links")
        if not links.isEmpty():
            found = components(links)
            if component is None:
                component = written(found.select(F.col("u").alias("fp"), F.col("root").alias("component")), "simhash-components")
            else:  # components that meet others take their root; a single fingerprint is its own component
                moved = component.join(found, component["component"] == found["u"], "left").select(
                    "fp", F.coalesce("root", "component").alias("component"))
                fresh = found.join(component, found["u"] == component["fp"], "left_anti").select(
                    F.col("u").alias("fp"), F.col("root").alias("component"))
                component = written(moved.unionAll(fresh), "simhash-components")
        if reach >= most or most <= ALL_AT_ONCE:
            break
        members = state.filter(F.col("size") > ALL_AT_ONCE).select(*members.columns)
        reach *= GROWTH
    if component is None:
        return nodes.limit(0).select("fp", F.col("fp").alias("component"))
    return component


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = written(fingerprints(docs), "simhash-rows")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    component = connected(nodes.select("fp"))
    named = nodes.join(component, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = written(named, "simhash-named")  # the hot fingerprint of the join below is split at run time
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = written(named.select("fp", "component").join(least, "component").select("fp", "component_id"), "simhash-answer")
    return rows.join(answer, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
