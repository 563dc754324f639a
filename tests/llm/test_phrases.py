import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, empty

from swingframe.llm import bloom, phrases
from swingframe.llm.quotient import Shape, planes, squeezed


def plain(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            totals[lang] += len(w)
            for k in range(1, 5):
                counts.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    candidates = {g: n for g, n in counts.items() if len(g) > 2 and n >= least}
    kept = {}
    for g, a in candidates.items():
        around = [n for h, n in candidates.items() if h[0] == g[0] and len(h) > len(g)
                  and any(h[1 + i:len(g) + i] == g[1:] for i in range(len(h) - len(g) + 1))]
        if any(100 * n >= 80 * a for n in around):
            continue
        cuts = [(2000000 * a // (counts[g[:k + 1]] + counts[g[:1] + g[k + 1:]]), k) for k in range(1, len(g) - 1)]
        score, k = min(cuts)
        kept.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), counts[g[:k + 1]], counts[g[:1] + g[k + 1:]]))
    return {(lang, rank, phrase.decode(), -a, left, right, totals[lang], -score) for lang, found in kept.items()
            for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)}


def texts(seed=11):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "ü.", "Big", "x\ty", "tail!", "\n"]
    fixed = ["New York City hall", "new york CITY", "of the people", "in spite of that", "kilo é metre"]
    rows = []
    for k in range(300):
        said = [draw.choice(fixed) if draw.random() < 0.3 else draw.choice(vocabulary[: 5 + k % 60]) for _ in range(draw.randrange(60))]
        rows.append((1000 + k, draw.choice([" ", "  ", "\t"]).join(said)))
    return rows


@pytest.mark.parametrize("least, top", [(5, 2000), (12, 25)])
def test_collocations_are_those_of_plain_counting(spark, least, top):
    docs = awkward(spark, texts())
    docs = docs.selectExpr("doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN 'fr' WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS lang", "1 AS id", "2 AS shard", "3 AS word")
    want = plain([(r.lang, r.text) for r in docs.collect()], least, top)
    got = phrases.collocations(docs, top=top, least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == want and len({w[0] for w in want}) == 3


def test_small_shards_and_filters_count_the_same(spark, monkeypatch):
    docs = awkward(spark, texts(12)).repartition(3)
    want = plain([(r.lang, r.text) for r in docs.collect()], 6, 2000)
    for name, value in (("SHARD_BYTES", 500), ("COUNTED_AT_ONCE", 300), ("MERGED_AT_ONCE", 5000), ("FILTER_BYTES", 64)):
        monkeypatch.setattr(phrases, name, value)
    assert {tuple(r) for r in phrases.collocations(docs, least=6).collect()} == want


def test_nothing_to_count(spark):
    assert phrases.collocations(empty(spark)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "one two", "en")], "doc_id long, text string, lang string")).count() == 0


def test_scores_pass_64_bits(spark):
    grams = spark.createDataFrame([([1, 2], 2 ** 58), ([1, 2, 3], 2 ** 57)], "ids array<long>, a long")
    counts = spark.createDataFrame([([1], 2 ** 60), ([2], 2 ** 59), ([3], 2 ** 57 + 3), ([1, 2], 2 ** 58), ([2, 3], 2 ** 57 + 1)], "ids array<long>, f long")
    got = {tuple(r.ids): r.score for r in phrases.cut_scores(grams, counts).collect()}
    assert got == {(1, 2): 2000000 * 2 ** 58 // (2 ** 60 + 2 ** 59), (1, 2, 3): 2000000 * 2 ** 57 // (2 ** 60 + 2 ** 57 + 1)}


@pytest.mark.parametrize("order, bits, cut", [(2, 1, 4), (2, 17, 5), (3, 17, 8), (4, 20, 6), (4, 32, 7), (3, 32, 3)])
def test_filters_lose_nothing(order, bits, cut):
    rng = np.random.default_rng(order * bits)
    shape = Shape(order, bits, cut)
    total, made = Counter(), {}
    for _ in range(3):
        ids = [rng.integers(0, min(1 << bits, 40), 3000).astype(np.uint64) for _ in range(order)]
        ids[0][:5] = (1 << bits) - 1
        total.update(zip(*(x.tolist() for x in ids)))
        halves = shape.permuted(*shape.packed(ids))
        assert all((a == b).all() for a, b in zip(shape.unpacked(*shape.restored(*halves)), ids))
        for segment, *row in shape.segments(*shape.summed(*halves, None)):
            made.setdefault(segment, []).append(tuple(row))
    found = Counter()
    for segment, filters in made.items():
        left, right, counts = shape.merged(segment, filters)
        assert (np.diff(left.astype(object)) >= 0).all()
        found.update(dict(zip(zip(*(x.tolist() for x in shape.unpacked(*shape.restored(left, right)))), counts.tolist())))
    assert found == total and len(made) <= 1 << cut


def _counted(shards, shape, known=None):
    batch = pa.RecordBatch.from_arrays(
        [pa.array([len(s) for s in shards], pa.int64()), pa.array([squeezed(planes(s)) for s in shards], pa.binary())], names=["size", "tokens"])
    return [b.to_pylist() for b in phrases.count_grams(shape, known)(iter([batch]))]


def test_counting_is_the_same_in_short_runs(monkeypatch):
    rng = np.random.default_rng(4)
    shards = [rng.integers(0, 6, n) for n in (200, 1, 77)]
    for order in (2, 3, 4):
        known = None
        if order > 2:
            known = bloom.Filter({0: 2})
            known.lanes[:] = rng.integers(1 << 62, 1 << 63, known.lanes.shape, np.uint64) | np.uint64(0x7777777777777777)
        whole = _counted(shards, Shape(order, 3, 2), known)
        monkeypatch.setattr(phrases, "HASHED_AT_ONCE", 5)
        assert whole and _counted(shards, Shape(order, 3, 2), known) == whole
        monkeypatch.undo()
    assert _counted([np.array([1, 2])], Shape(4, 3, 2)) == [[]]


def test_counting_takes_little_memory():
    rng = np.random.default_rng(1)
    shards = [np.minimum(rng.zipf(1.25, 700_000), 60_000) for _ in range(4)]
    tracemalloc.start()
    try:
        _counted(shards, Shape(2, 16, 6))
        assert tracemalloc.get_traced_memory()[1] < 110e6
    finally:
        tracemalloc.stop()
