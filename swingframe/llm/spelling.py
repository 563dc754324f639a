"""Spelling variants by Bloom-guided neighbourhoods.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF; A-Z lowered), counted over all
documents. A word's neighbours differ from it by one inserted, deleted or replaced code point.
Every word generates its edits: the strings with one code point less, and those with one code
point replaced by a later one of the vocabulary's alphabet (the other direction of a pair is found
from its other end). Edits are hashes, changed in place from the word's own, and are probed
against blocked Bloom filters of the vocabulary, one for each length, which are broadcast. Only edits that pass
become strings and are shuffled to the exact vocabulary, which removes the false ones; so no pair
of words is missed, and none is compared that a filter rules out.

The filters take FILTER_BYTES at most: a larger vocabulary is dealt by hash into as many parts as
it takes, and one part after another is broadcast and probed.

A word's form is its most frequent neighbour (ties: the smallest in code-point order) where that
is at least LEAD times as frequent. Counts grow by that factor with each step, so forms have no
cycles, and their chains are short enough for a few doubling joins, whose number follows
from the largest count.

Defined results: a null text has no words; a null doc_id counts as the empty text in a run's
hash. Repeated rows count as often as they occur. A run of any length is taken whole; its edits
are generated a position at a time. An empty table, or one without words that qualify, gives no
rows. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe.llm import bloom
from swingframe.llm.store import written
from swingframe.llm.words import BASE, GOLDEN, LOWERED, mix, pieces, runs

SHORTEST = 7
LEAST = 2
LEAD = 10
CUT = 31  # one run in so many loses a code point
FILTER_BYTES = 32 << 20
HELD_WORDS = 1 << 17  # distinct words a task counts before it passes them on
LEAD_BYTE = 0xC3  # first UTF-8 byte of U+00C0 to U+00FF
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[0x61:0x7B] = True
INVERSE = np.uint64(pow(BASE, -1, 1 << 64))


def long_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Lowered runs of SHORTEST code points at least, their texts, and their lengths in code points."""
    low = LOWERED[data]
    lead = low == LEAD_BYTE
    inside = ASCII_LETTER[low] | lead
    inside[1:] |= lead[:-1]
    starts, ends, owner = runs(inside, offsets)
    led = np.concatenate([[0], np.cumsum(lead)])
    length = ends - starts - (led[ends] - led[starts])
    fit = length >= SHORTEST
    text = low.tobytes()
    return [text[a:b] for a, b in zip(starts[fit].tolist(), ends[fit].tolist())], owner[fit], length[fit]


def counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])


def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id as text and text in; partial counts of words out."""
    counts: Counter = Counter()
    for batch in batches:
        names = batch.column(0).to_pylist()
        for first, _, data, offsets in pieces(batch.column(1)):
            found, owner, length = long_runs(data, offsets)
            begun = [crc32(f"{name or ''}:".encode()) for name in names[first: first + len(offsets) - 1]]
            hashes = np.array(list(map(crc32, found, [begun[k] for k in owner.tolist()])), np.int64)
            for k in np.flatnonzero(hashes % CUT == 0).tolist():
                word, at = found[k].decode(), int(hashes[k] % length[k])
                word = word[:at] + word[at + 1:]
                found[k] = word.encode() if len(word) >= SHORTEST else b""
            counts.update(found)
            if len(counts) > HELD_WORDS:
                counts.pop(b"", None)
                yield counted(counts)
                counts.clear()
    counts.pop(b"", None)
    yield counted(counts)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n, length of the words that occur LEAST times at least."""
    rows = docs.select(F.col("doc_id").cast("string").alias("name"), "text")
    counts = rows.mapInArrow(count_runs, "word string, c long").groupBy("word").agg(F.sum("c").alias("n"))
    return counts.filter(F.col("n") >= LEAST).select("word", "n", F.length("word").alias("length"))


def value(code_points: np.ndarray) -> np.ndarray:
    return mix(code_points.astype(np.uint64) * GOLDEN + np.uint64(1))


def by_length(words: pa.Array) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Words of one length, their code points (a row each), and the powers of BASE."""
    groups: dict[int, list[str]] = {}
    for word in words.to_pylist():
        groups.setdefault(len(word), []).append(word)
    for length, found in groups.items():
        letters = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).reshape(-1, length)
        powers = np.ones(length, np.uint64)
        powers[1:] = np.multiply.accumulate(np.full(length - 1, BASE, np.uint64))
        yield found, letters, powers


def hashes_of(letters: np.ndarray, powers: np.ndarray) -> np.ndarray:
    return (value(letters) * powers).sum(axis=1, dtype=np.uint64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(keys ^ GOLDEN) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def keyed(parts: int, part: int):
    """Shards and keys of the words of one part, for ``bloom.built``."""
    def keys(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for _, letters, powers in by_length(batch.column(0)):
            found = mix(hashes_of(letters, powers))
            yield letters.shape[1], found[part_of(found, parts) == part]

    return keys


def edits(known: bloom.Filter, alphabet: np.ndarray, parts: int, part: int):
    """A function for mapInArrow: words in; (word, edit) of the edits that pass the filters out."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, codes = value(alphabet), alphabet.tolist()
        for batch in batches:
            for words, letters, powers in by_length(batch.column(0)):
                length, values = letters.shape[1], value(letters)
                whole = (values * powers).sum(axis=1, dtype=np.uint64)
                before = np.zeros(len(words), np.uint64)
                source, made = [], []

                def passed(shard: int, keys: np.ndarray) -> np.ndarray:
                    mine = np.flatnonzero(part_of(keys, parts) == part) if parts > 1 else None
                    at = known.holds(shard, keys if mine is None else keys[mine])
                    return at if mine is None else mine[at]

                for i in range(length):
                    here = values[:, i] * powers[i]
                    if length > SHORTEST:
                        distinct = np.flatnonzero(letters[:, i] != letters[:, i - 1]) if i else np.arange(len(words))
                        keys = mix(before[distinct] + (whole - before - here)[distinct] * INVERSE)
                        for k in distinct[passed(length - 1, keys)].tolist():
                            source.append(words[k])
                            made.append(words[k][:i] + words[k][i + 1:])
                    row, sign = np.nonzero(alphabet[None, :] > letters[:, i, None])
                    keys = mix((whole - here)[row] + signs[sign] * powers[i])
                    for at in passed(length, keys).tolist():
                        word = words[row[at]]
                        source.append(word)
                        made.append(word[:i] + chr(codes[sign[at]]) + word[i + 1:])
                    before += here
                yield pa.RecordBatch.from_arrays([pa.array(source, pa.string()), pa.array(made, pa.string())], names=["word", "near"])

    return probe


def near_pairs(vocab: DataFrame, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, near, near_n: both directions of every pair of neighbours, each once."""
    spark = vocab.sparkSession
    sizes = {r["length"]: r["n"] for r in vocab.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect()}
    signs = vocab.select(F.explode(F.split("word", "")).alias("sign")).filter("sign <> ''").distinct().collect()  # 90 letters at most
    alphabet = np.array(sorted(ord(r["sign"]) for r in signs), np.uint32)
    parts = max(1, -(-sum(map(bloom.blocks_for, sizes.values())) * bloom.BLOCK_BYTES // most_bytes))
    blocks = {length: bloom.blocks_for(-(-n // parts)) for length, n in sizes.items()}
    words, found = vocab.select("word"), None
    for part in range(parts):
        known = bloom.built(words, blocks, keyed(parts, part))
        passed = words.mapInArrow(edits(known, alphabet, parts, part), "word string, near string")
        found = written(passed, "spelling-edits") if found is None else found.unionAll(written(passed, "spelling-edits"))
    if found is None:
        found = spark.createDataFrame([], "word string, near string")
    true = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    half = found.join(true, "near").join(vocab.select("word", "n"), "word")
    half = written(half, "spelling-pairs")
    return half.select("word", "near", "near_n").unionAll(
        half.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) from (word, form): after k joins a word knows its 2**k-th form."""
    steps = max(0, math.floor(math.log(max(most, 1), LEAD) + 1e-9))  # a chain's counts grow by LEAD
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(steps, 1))))):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = written(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return reached


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    vocab = written(vocabulary(docs), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_pairs(vocab).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    leads = F.col("n_near").isNotNull() & (-F.col("best.less") >= LEAD * F.col("n"))
    rows = written(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n")), "spelling-forms")
    most = vocab.agg(F.max("n")).first()[0] or 1
    chains = roots(rows.filter("form IS NOT NULL"), most)
    return rows.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
