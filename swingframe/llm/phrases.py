"""Phrase collocations, counted in counting quotient filters.

Texts (A-Z lowered) are split at . , ; : ! ? and line breaks into pieces, and pieces at spaces and tabs into words.
Everything is counted for each language (null: und). A phrase is LONGEST words at most; the candidates are
phrases with LEAST occurrences at least, overlapping ones included.

1. Each task turns its texts into shards of local word numbers (SHARD_BYTES of text; a longer text makes a larger
   one) with the shard's own dictionary. Word counts are sums over dictionaries; words with LEAST occurrences get
   dense numbers, which are joined back to every dictionary, and shards are rewritten in them. So no task holds
   more than a shard's words, and words are told apart by their bytes, not by a hash.
2. For 2, 3, ... words, tasks count packed n-grams in counting quotient filters (``quotient``), cut into
   segments; a segment's filters are shuffled to one task and merged. An n-gram that occurs often consists of words
   and shorter n-grams that do. Positions where that is ruled out by a Bloom filter of the last length's
   frequent n-grams (FILTER_BYTES at most, at any vocabulary) are not counted; what it wrongly passes is counted
   and dropped at the threshold, so counts are exact.
3. Cuts, scores, containment and rank are DataFrame joins on the numbers of the words. Scores are exact
   (decimals of 38 digits).

Defined results: null and empty texts have no words; a text of any length is taken whole. Repeated rows count as often
as they occur. Ties in score go by occurrences, then by the phrase's bytes; ties of cuts to the first. An empty
table gives no rows. Only text and lang are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swingframe.llm import bloom
from swingframe.llm.quotient import Shape, from_planes, planes, squeezed, unsqueezed
from swingframe.llm.store import written
from swingframe.llm.words import GOLDEN, mix, pieces

LONGEST = 4
LEAST = 30
FACTOR = 2_000_000
TOP = 2000
SHARD_BYTES = 4 << 20
FILTER_BYTES = 32 << 20
COUNTED_AT_ONCE = 1 << 21  # words whose n-grams a task counts in one filter
HASHED_AT_ONCE = 1 << 17  # words whose n-grams are hashed and packed in one go
MERGED_AT_ONCE = 1 << 21  # words behind the filters of one merging task
BREAK = b"\n"
CHARACTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c == 0x09 else 0x0A if c in b".,;:!?\x0a\x0b\x0c\x0d" else c for c in range(256))


class Numbers(dict):
    """Gives every new word the next number; a break is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text in; lang, tokens, size, word, c of shards out."""
    held: dict[str, tuple[Numbers, list[int]]] = {}
    size = 0

    def shards() -> pa.RecordBatch:
        rows = []
        for lang, (numbers, tokens) in held.items():
            ids = np.array(tokens, np.int64)
            rows.append((lang, squeezed(planes(ids)), len(ids), list(numbers)[1:], np.bincount(ids, minlength=len(numbers))[1:]))
        offsets = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])]).astype(np.int32)
        words = pa.array([w for r in rows for w in r[3]], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()),
             pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[4] for r in rows])))],
            names=["lang", "tokens", "size", "word", "c"])

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, _, data, offsets in pieces(batch.column(1)):
            whole, ends = data.tobytes().translate(CHARACTERS), offsets.tolist()
            for k, (a, b) in enumerate(zip(ends, ends[1:])):
                if a == b:
                    continue
                if (lang := langs[first + k]) not in held:
                    held[lang] = (Numbers({BREAK: 0}), [])
                numbers, tokens = held[lang]
                tokens.extend(map(numbers.__getitem__, filter(None, whole[a:b].replace(BREAK, b" \n ").split(b" "))))
                tokens.append(0)
                size += b - a
                if size >= SHARD_BYTES:
                    yield shards()
                    held, size = {}, 0
    if held:
        yield shards()


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written, with a dense id; only a count of each partition reaches the driver."""
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    starts = np.concatenate([[0], np.cumsum([r["n"] for r in sizes])]).tolist()
    base = rows.sparkSession.createDataFrame([(r["part"], a) for r, a in zip(sizes, starts)], "part long, base long")
    joined = rows.withColumn("part", part).join(F.broadcast(base), "part")  # a row for each partition of the table
    return joined.withColumn("id", F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "base", "at")


def recoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """tokens, size, words, pairs (at, id) in; size and tokens in global numbers (0: none) out."""
    for batch in batches:
        for k in range(batch.num_rows):
            size, words = batch.column(1)[k].as_py(), batch.column(2)[k].as_py()
            local, _ = from_planes(unsqueezed(batch.column(0)[k].as_py()), 0, size)
            table = np.zeros(words + 1, np.uint64)
            pairs = batch.column(3)[k].values
            if pairs is not None:
                table[pairs.field(0).to_numpy() + 1] = pairs.field(1).to_numpy().astype(np.uint64) + np.uint64(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int64()), pa.array([squeezed(planes(table[local.astype(np.int64)]))], pa.binary())], names=["size", "tokens"])


def gram_keys(ids: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(ids[0]), np.uint64)
    for x in ids:
        out = mix(out + (x.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    return out


def windows(tokens: np.ndarray, shape: Shape, known: bloom.Filter | None) -> Iterator[list[np.ndarray]]:
    """The ids of every n-gram that may be frequent, run by run; tokens are ids + 1, 0 between."""
    order, count = shape.order, max(0, len(tokens) - shape.order + 1)
    whole = np.ones(count, bool)
    for k in range(order):
        whole &= tokens[k: k + count] > 0
    if known is not None:
        shorter = np.concatenate([whole, np.zeros(1, bool)]) | np.concatenate([np.zeros(1, bool), whole])
        may = np.zeros(count + 1, bool)
        for a in range(0, count + 1, HASHED_AT_ONCE):
            starts = a + np.flatnonzero(shorter[a: a + HASHED_AT_ONCE])
            may[starts[known.holds(0, gram_keys([tokens[starts + k] - np.uint64(1) for k in range(order - 1)]))]] = True
        whole &= may[:-1] & may[1:]
    for a in range(0, count, HASHED_AT_ONCE):
        heads = a + np.flatnonzero(whole[a: a + HASHED_AT_ONCE])
        yield [tokens[heads + k] - np.uint64(1) for k in range(order)]


def count_grams(shape: Shape, known: bloom.Filter | None) -> Callable:
    """For mapInArrow: size, tokens in; (segment, quotient, keys, filter) out."""
    def keys(held: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        tokens = np.concatenate(held)
        held.clear()
        for ids in windows(tokens, shape, known):
            yield shape.permuted(*shape.packed(ids))

    def filters(held: list[np.ndarray]) -> pa.RecordBatch:
        lefts, rights = zip(*keys(held)) if sum(map(len, held)) >= shape.order else ([np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)])
        left, right = np.concatenate(lefts), np.concatenate(rights)
        del lefts, rights
        rows = shape.segments(*shape.summed(left, right, None))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
            names=["segment", "quotient", "keys", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for k in range(batch.num_rows):
                held.append(from_planes(unsqueezed(batch.column(1)[k].as_py()), 0, batch.column(0)[k].as_py())[0])
                if sum(map(len, held)) >= COUNTED_AT_ONCE:
                    yield filters(held)
                    held = []
        if held:
            yield filters(held)

    return run


def merge_filters(shape: Shape, least: int) -> Callable:
    """For mapInArrow: all filters of some segments in; ids and a of the frequent n-grams out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, int, bytes]]] = {}
        for batch in batches:
            for segment, *row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                held.setdefault(segment, []).append(tuple(row))
        for segment in sorted(held):
            left, right, counts = shape.merged(segment, held.pop(segment))
            often = counts >= least
            ids = shape.unpacked(*shape.restored(left[often], right[often]))
            flat = np.stack(ids, axis=1).astype(np.int64).ravel()
            offsets = (np.arange(int(often.sum()) + 1) * shape.order).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(counts[often])], names=["ids", "a"])

    return run


def gram_filter(grams: DataFrame, order: int) -> bloom.Filter:
    count = grams.count()

    def keyed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        ids = batch.column(0).flatten().to_numpy().reshape(-1, order)
        yield 0, gram_keys([ids[:, k] for k in range(order)])

    return bloom.built(grams.select("ids"), {0: min(bloom.blocks_for(count), FILTER_BYTES // bloom.BLOCK_BYTES)}, keyed)


def frequent(coded: DataFrame, words: int, total: int, least: int) -> DataFrame:
    """ids, a of every n-gram of 2 to LONGEST words with ``least`` occurrences."""
    spark, bits = coded.sparkSession, max(1, (words - 1).bit_length())
    if bits > 32:
        raise ValueError("more than 2**32 frequent words")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // MERGED_AT_ONCE))
    found, known = None, None
    for order in range(2, LONGEST + 1):
        shape = Shape(order, bits, (4 * tasks - 1).bit_length())
        filters = coded.select("size", "tokens").mapInArrow(count_grams(shape, known), "segment int, quotient int, keys long, filter binary")
        grams = filters.repartition(tasks, "segment").mapInArrow(merge_filters(shape, least), "ids array<long>, a long")
        grams = written(grams, f"phrase-grams{order}")
        found = grams if found is None else found.unionAll(grams)
        if order < LONGEST:
            known = gram_filter(grams, order)
    return found


def cut_scores(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """ids, a, l, r, score of each phrase at its lowest-scoring cut; counts: ids, f of phrases and words."""
    cuts = grams.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.expr("slice(ids, 1, k)").alias("first"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("rest"))
    cuts = cuts.join(counts.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(counts.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr(f"(CAST(a AS DECIMAL(29, 0)) * CAST({FACTOR} AS DECIMAL(9, 0))) div CAST(l + r AS DECIMAL(20, 0))")
    lowest = cuts.groupBy("ids").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("ids", "a", "cut.l", "cut.r", "cut.score")


def contained(grams: DataFrame) -> DataFrame:
    """ids, longer: the largest count of a longer phrase around each phrase that has one."""
    parts = F.expr("""flatten(transform(sequence(2, size(ids) - 1), n ->
                      transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n))))""")
    return grams.filter(F.size("ids") > 2).select(F.explode(parts).alias("ids"), F.col("a").alias("f")) \
        .groupBy("ids").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each language."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    shards = rows.mapInArrow(encoded, "lang string, tokens binary, size long, word array<string>, c array<long>")
    shards = written(shards.withColumn("shard", F.monotonically_increasing_id()), "phrase-shards")
    entries = shards.select("shard", "lang", F.posexplode(F.arrays_zip("word", "c")).alias("at", "x")) \
        .select("shard", "lang", "at", "x.word", "x.c")
    totals = entries.groupBy("lang", "word").agg(F.sum("c").alias("f"))
    sums = written(entries.groupBy("lang").agg(F.sum("c").alias("n")), "phrase-langs")
    words = written(numbered(totals.filter(F.col("f") >= least), "phrase-words"), "phrase-words")
    pairs = entries.select("shard", "lang", "at", "word").join(words.select("lang", "word", "id"), ["lang", "word"]) \
        .groupBy("shard").agg(F.collect_list(F.struct("at", "id")).alias("pairs"))
    coded = shards.select("shard", "tokens", "size", F.size("word").alias("words")).join(pairs, "shard", "left") \
        .select("tokens", "size", "words", "pairs")
    coded = written(coded.mapInArrow(recoded, "size long, tokens binary"), "phrase-coded")
    total = sums.agg(F.sum("n")).first()[0] or 0
    grams = frequent(coded, words.count(), total, least)
    counts = grams.select("ids", F.col("a").alias("f")).unionAll(words.select(F.array("id").alias("ids"), "f"))
    scored = cut_scores(grams, counts).join(contained(grams), "ids", "left") \
        .filter(F.col("longer").isNull() | (5 * F.col("longer") < 4 * F.col("a"))).drop("longer")
    scored = written(scored.withColumn("gram", F.monotonically_increasing_id()), "phrase-scores")
    spelt = scored.select("gram", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id") \
        .groupBy("gram").agg(F.first("lang").alias("lang"), F.array_join(F.expr("transform(array_sort(collect_list(struct(at, word))), x -> x.word)"), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.join(spelt, "gram").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
