"""Near duplicates by ProbMinHash, banding and exact verification.

A text is the weighted set of its five-word shingles (blank-separated words, A-Z lowered;
a shingle seen n times weighs 1 + ln n; a text of fewer words is one shingle). Similarity is
the probability Jaccard index, which is plain Jaccard where no shingle repeats. Every shingle
has a Poisson process of arrivals whose rate is its weight; an arrival falls into one of
BANDS * ROWS registers, and a register keeps the shingle that came first. A shingle stops as
soon as its next arrival is later than the latest register, so long texts cost one arrival
for most shingles. Registers of two texts agree with the probability of their similarity.

Six bits of every register are kept, a long for each band. Texts that agree in a band share a bucket.
Equal texts are one node, so a bucket holds different texts only. Pairs of which too many registers differ
for a similarity of 0.8 (by five standard deviations) are dropped inside the join of a bucket's members, and a
pair is taken in the first band in which it agrees only. A bucket is not expanded into pairs: its members are
compared, on whole texts, with a pivot; what is linked becomes one component; then with GROWTH times as
many pivots, but only members that are not yet connected to them, until the bucket is one
component or every pair of its components has been compared. A group of copies is done
after one comparison per member, and no link between two texts that share a bucket is lost. What bounds the
work is how often texts share a bucket without becoming one component: n such texts cost n**2 / 2 evaluations
of the bits in the end.

Two texts of similarity 0.8 share a bucket with probability 1 - (1 - 0.8**10)**50 = 0.997, of
similarity 0.85 with 0.9999.

Defined results: null counts as empty; texts without words are one class. A text of any length is taken
whole; an empty table gives no rows; ties of similarity do not arise, as every pair at the threshold links. The class id is
the smallest doc_id of the class (null ids rank last). Repeated rows are members each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe.llm.graph import components
from swingframe.llm.store import free_name, written
from swingframe.llm.words import GOLDEN, mix, pieces, step, sums_by, unit, word_hashes

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 50, 10
REGISTERS = BANDS * ROWS
REGISTER_BITS = 6  # kept of every register; a band's are one long, which also names its bucket
FIRST = 10  # bands that a pair is looked at first
LOWEST = sum(1 << (REGISTER_BITS * k) for k in range(ROWS))


def most_apart(registers: int) -> float:
    """Registers that differ in their bits at the threshold, and five deviations more."""
    apart = (1 - THRESHOLD) * (1 - 2.0 ** -REGISTER_BITS)
    return apart * registers + 5 * (apart * (1 - apart) * registers) ** 0.5


GROWTH = 8  # times as many pivots in a bucket's next round
PLACES = mix(np.arange(11, 11 + WORDS, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def shingles(words: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, 48-bit shingle and count of every distinct shingle, ordered by text and shingle."""
    count = sums_by(owner, None, texts)
    start = np.cumsum(count) - count
    at = np.arange(len(words)) - start[owner]
    whole = np.flatnonzero(at <= count[owner] - WORDS)
    value = np.zeros(len(whole), np.uint64)
    for k in range(WORDS):
        value += words[whole + k] * PLACES[k]
    short = np.flatnonzero((count > 0) & (count < WORDS))
    value_of_short = np.zeros(len(short), np.uint64)
    for k in range(WORDS - 1):
        has = count[short] > k
        value_of_short[has] += words[start[short[has]] + k] * PLACES[k]
    value = np.concatenate([value, value_of_short + count[short].astype(np.uint64)])
    text = np.concatenate([owner[whole], short])
    keys = np.sort((text.astype(np.uint64) << np.uint64(48)) | (mix(value) >> np.uint64(16)))
    fresh = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(fresh, len(keys)))
    keys = keys[fresh]
    return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1), times


def weights(times: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(times)


def registers(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """The first shingle to arrive in each register of each text (0 for texts without any)."""
    first = np.full(texts * REGISTERS, np.inf)
    winner = np.zeros(texts * REGISTERS, np.uint64)
    seed, clock, turn = mix(shingle + GOLDEN), np.zeros(len(shingle)), 0
    active = np.arange(len(shingle))
    latest = np.full(texts, np.inf)
    while len(active):
        turn += 1
        draw = mix(seed[active] + step(turn))
        clock[active] -= np.log(unit(draw)) / weight[active]
        active = active[(soon := clock[active] < latest[text[active]])]
        slot = text[active] * REGISTERS + ((mix(draw[soon]) >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(first, slot, clock[active])
        won = clock[active] == first[slot]
        winner[slot[won]] = shingle[active[won]]
        live = np.unique(text[active])
        latest[live] = first.reshape(texts, REGISTERS)[live].max(axis=1)
        active = active[clock[active] < latest[text[active]]]
    return winner.reshape(texts, REGISTERS)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, doc_id, text hash in; those, a digest of the words and the bucket of every band out."""
    for batch in batches:
        for begin, end, data, offsets in pieces(batch.column(3)):
            texts = end - begin
            words, owner = word_hashes(data, offsets)
            text, shingle, times = shingles(words, owner, texts)
            won = registers(text, shingle, weights(times), texts)
            count = sums_by(owner, None, texts)
            at = (np.arange(len(words)) - (np.cumsum(count) - count)[owner]).astype(np.uint64)
            digests = []
            for salt in (1, 2):
                part = mix(words ^ (mix(at * GOLDEN + np.uint64(salt))))
                total = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
                ends = np.cumsum(count)
                digests.append(total[ends] - total[ends - count])
            spoken = np.flatnonzero(count)
            low = (mix(won[spoken]) >> np.uint64(40)) & np.uint64((1 << REGISTER_BITS) - 1)
            low = low.reshape(len(spoken), BANDS, ROWS) << (np.arange(ROWS, dtype=np.uint64) * np.uint64(REGISTER_BITS))
            bits = np.bitwise_or.reduce(low, axis=2)
            sizes = np.zeros(texts + 1, np.int32)
            sizes[spoken + 1] = 1
            part = batch.slice(begin, texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), *(pa.array(d.view(np.int64)) for d in digests),
                 pa.ListArray.from_arrays(pa.array(np.cumsum(sizes * BANDS, dtype=np.int32)), pa.array(bits.ravel().view(np.int64)))],
                names=["row", "doc_id", "hash", "d1", "d2", "bits"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard index of two weighted sets given as (sorted keys, weights).

    For a common key i the index adds 1 / sum_j max(a_j / a_i, b_j / b_i). With keys in order
    of b_j / a_j, a's share wins up to i and b's share beyond, so two running sums do."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    x, y = a[1][same], b[1][at[same]]
    if not len(x):
        return 0.0
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    up = a[1].sum() - x.sum() + np.cumsum(x)
    down = b[1].sum() - y.sum() + (y.sum() - np.cumsum(y))
    return float((1 / (up / x + down / y)).sum())


def weighted_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for begin, end, data, offsets in pieces(column):
        words, owner = word_hashes(data, offsets)
        text, shingle, times = shingles(words, owner, end - begin)
        cut = np.searchsorted(text, np.arange(end - begin + 1))
        for k in range(end - begin):
            yield shingle[cut[k]: cut[k + 1]], weights(times[cut[k]: cut[k + 1]])


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, text a, text b) in, (u, v) of the pairs that are similar out."""
    for batch in batches:
        held = [similarity(a, b) >= THRESHOLD - 1e-12 for a, b in zip(weighted_sets(batch.column(2)), weighted_sets(batch.column(3)))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(k).filter(pa.array(held, pa.bool_())) for k in (0, 1)], names=["u", "v"])


def registers_apart(x: Column, y: Column) -> Column:
    """How many registers of a band differ in their bits."""
    both = x.bitwiseXOR(y)
    both = both.bitwiseOR(F.shiftrightunsigned(both, 3))
    both = both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseOR(F.shiftrightunsigned(both, 2))
    return F.bit_count(both.bitwiseAND(F.lit(LOWEST)))


def alike(x: Column, y: Column) -> Column:
    """Whether two texts may be similar, from the bits of a few bands (in generated code), then of all."""
    few = sum((registers_apart(x[k], y[k]) for k in range(FIRST)), F.lit(0))
    whole = F.aggregate(F.zip_with(x, y, registers_apart), F.lit(0), lambda a, b: a + b)
    return (few <= most_apart(FIRST * ROWS)) & (whole <= most_apart(REGISTERS))


def first_shared(x: Column, y: Column) -> Column:
    """The first band in which two texts agree."""
    return F.array_position(F.zip_with(x, y, lambda a, b: a == b), True) - 1


def sketched(docs: DataFrame) -> DataFrame:
    """row, doc_id, hash of the text as it is, digest of its words, buckets; written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("hash"), "text")
    return written(rows.mapInArrow(sketch, f"row long, doc_id {kind}, hash long, d1 long, d2 long, bits array<long>"), "near-sketch")


def connected(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) of the nodes that are linked to another one.

    nodes: node (a row number), doc_id, hash, bits; one row for each different text."""
    members = nodes.select("node", F.posexplode("bits").alias("band", "value"), F.xxhash64("node").alias("luck"))
    members = members.select("node", "band", F.xxhash64("band", "value").alias("bucket"), "luck")
    shared = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("luck").alias("best")).filter("size > 1")
    members = written(members.join(shared, "bucket"), "near-members")
    component = nodes.select("node", F.col("node").alias("component"), "bits").join(members.select("node"), "node", "left_semi")
    wanted = nodes.join(component.select("node"), "node").select("node", F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    texts = written(rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["__id"]) & (rows["hash"] == wanted["__hash"]))
                    .groupBy("node").agg(F.first("text").alias("text")), "near-texts")
    component = written(component, "near-components")
    luck = F.pmod("luck", F.lit(1 << 52)) / F.lit(float(1 << 52)) * F.col("size")
    reach = 1
    while True:
        state = members.join(component, "node")
        unsettled = state.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
            .filter("low <> high").select("bucket")
        first = F.col("luck") == F.col("best")
        left = written(state.join(unsettled, "bucket").withColumns({
            "now": first | (luck < float(reach)),
            "old": F.lit(False) if reach == 1 else first | (luck < float(reach // GROWTH))}), "near-left")
        most = left.agg(F.max("size")).first()[0]
        if most is None:
            return component
        pivots = left.filter("now AND NOT old").select("bucket", "band", F.col("node").alias("a"), F.col("component").alias("u"), F.col("bits").alias("x"))
        others = left.filter("NOT old").select("bucket", F.col("node").alias("b"), F.col("component").alias("v"), "now", F.col("bits").alias("y"))
        x, y = F.col("x"), F.col("y")
        pairs = pivots.join(others, "bucket").filter(F.expr("u <> v AND (NOT now OR a < b)") & alike(x, y) & (first_shared(x, y) == F.col("band"))) \
            .select("a", "b", "u", "v")
        ready = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b") \
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").select("u", "v", "ta", "tb")
        links = written(ready.mapInArrow(verify, "u long, v long"), "near-links")
        if not links.isEmpty():
            roots = components(links)
            component = written(component.join(roots, component["component"] == roots["u"], "left")
                                .select("node", F.coalesce("root", "component").alias("component"), "bits"), "near-components")
        if reach >= most:  # every member of an unsettled bucket has been a pivot
            return component
        members = left.select("bucket", "band", "node", "size", "luck", "best")
        reach *= GROWTH


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, and hash of its text."""
    rows = sketched(docs)
    # written, so that the join below has exchanges of its own, which are split where one text is hot
    best = written(rows.groupBy("d1", "d2").agg(F.min("row").alias("node")), "near-best")
    named = written(rows.select("row", "doc_id", "hash", "d1", "d2").join(best, ["d1", "d2"]).select("row", "doc_id", "hash", "node"), "near-rows")
    nodes = named.filter("row = node").select("node", "doc_id", "hash").join(
        rows.select(F.col("row").alias("node"), "bits"), "node")
    component = connected(docs, nodes).select("node", "component")
    by_node = named.groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first"), F.count("*").alias("n"))
    by_node = by_node.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    by_node = written(by_node, "near-nodes")
    classes = by_node.groupBy("component").agg(F.min("first").alias("lead"), F.sum("n").alias("class_size"))
    answer = by_node.select("node", "component").join(classes, "component").select("node", "lead", "class_size")
    return named.join(answer, "node").select(
        "doc_id", F.col("lead.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("lead.row")).alias("kept"), "hash")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, unchanged."""
    key, sha, mine, n = (free_name(docs.columns, x) for x in ("kept_id", "kept_hash", "text_hash", "copy"))
    kept = near_classes(docs).filter("kept").select(F.col("doc_id").alias(key), F.col("hash").alias(sha))
    rows = docs.withColumn(mine, F.xxhash64("text"))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept[key]) & (rows[mine] == kept[sha]), "left_semi")
    first = Window.partitionBy("doc_id", mine).orderBy(mine)
    return rows.withColumn(n, F.row_number().over(first)).filter(F.col(n) == 1).select(*docs.columns)
