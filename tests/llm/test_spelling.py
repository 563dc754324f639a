import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from helpers import awkward, empty

from swingframe.llm import bloom, spelling
from swingframe.llm.words import GOLDEN, mix

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(counts):
    forms, found = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * n else None
        found[w] = len(close)
    rows = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, found[w], counts.get(forms[w])))
    return rows


def texts(seed=7):
    draw = random.Random(seed)
    stems = ["analysis", "behaviour", "Colourful", "élèveront", "naïveté's", "straßenweg", "aaaaaaaa", "Œuvresque", "ÀÉÎÕÜàéî"]
    rows = []
    for k in range(160):
        said = []
        for _ in range(draw.randrange(60)):
            word = draw.choice(stems[:1 + k % len(stems)])
            if draw.random() < 0.2:
                at = draw.randrange(len(word))
                word = draw.choice([word[:at] + word[at + 1:], word[:at] + draw.choice("aeéz") + word[at:], word[:at] + "b" + word[at + 1:]])
            said.append(word)
        rows.append((1000 + k, draw.choice([" ", "-", "7", "\n"]).join(said)))
    for n, word in ((2, "chainedwordaaa"), (25, "chainedwordaab"), (260, "chainedwordabb"), (2700, "chainedwordbbb")):
        rows += [(5000 + n * 10 + k, " ".join([word] * (n // 2))) for k in range(2)]
    return rows


def test_variants_are_those_of_all_pairs(spark):
    docs = awkward(spark, texts())
    counts = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    want = plain_variants(counts)
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert any(form and form != root for _, form, root, *_ in want) and sum(r[1] is not None for r in want) > 10


def test_parts_of_a_large_vocabulary_find_the_same(spark):
    docs = awkward(spark, texts(9))
    vocab = spelling.vocabulary(docs)
    vocab = spark.createDataFrame(vocab.collect(), vocab.schema)
    one = sorted(map(tuple, spelling.near_pairs(vocab).collect()))
    assert one and sorted(map(tuple, spelling.near_pairs(vocab, most_bytes=bloom.BLOCK_BYTES * 3).collect())) == one


def test_no_words(spark):
    assert spelling.variants(empty(spark)).count() == 0
    alone = spark.createDataFrame([(1, "short words once longerword")], "doc_id long, text string")
    assert spelling.variants(alone).count() == 0


def test_a_very_long_run(spark):
    long_run = "ab" * 900
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([long_run, long_run + "c", long_run, long_run + "c"] * 3)], "doc_id long, text string")
    counts = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    assert {(r.word, r.n_near) for r in spelling.variants(docs).collect()} == {(w, sum(near(w, v) for v in counts)) for w in counts}


def test_a_filter_misses_no_key_and_passes_few_others(spark):
    keys = mix(np.arange(20000, dtype=np.uint64) * GOLDEN)
    rows = spark.range(20000).select("id")
    blocks = {1: bloom.blocks_for(10000), 2: bloom.blocks_for(10000), 3: 1}

    def keyed(batch):
        at = batch.column(0).to_numpy()
        found = mix(at.astype(np.uint64) * GOLDEN)
        for shard in (1, 2):
            yield shard, found[at % 2 == shard - 1]

    made = bloom.built(rows, blocks, keyed)
    assert len(made.holds(1, keys[::2])) == len(made.holds(2, keys[1::2])) == 10000
    assert len(made.holds(1, keys[1::2])) < 40 and len(made.holds(3, keys)) == len(made.holds(9, keys)) == 0


def test_hashes_of_edits_change_in_place():
    word = "abcdéfgh"
    (_, letters, powers), = spelling.by_length(pa.array([word]))
    whole = spelling.hashes_of(letters, powers)[0]
    values = spelling.value(letters[0])
    whole = np.array([whole])
    i = 3
    before = (values[:i] * powers[:i]).sum(dtype=np.uint64)
    cut = before + (whole - before - values[i] * powers[i]) * spelling.INVERSE
    (_, fewer, p), = spelling.by_length(pa.array([word[:i] + word[i + 1:]]))
    assert cut == spelling.hashes_of(fewer, p)[0]
