import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import awkward, empty

from swingframe.llm import quality, toxicity
from swingframe.llm.words import pieces

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(spark, count=500):
    draw = random.Random(1)
    clean = ["river", "stone", "walk", "green", "paper", "window", "small", "quiet", "garden", "music"]
    rows, labels = [], []
    for k in range(count):
        bad, foul = draw.random() < 0.3, draw.random() < 0.3
        lines = []
        for _ in range(draw.randint(1, 5)):
            words = [draw.choice(clean) for _ in range(draw.randint(4, 15))]
            lines.append(" ".join(w.upper() + "!!" if bad else w for w in words) + ".")
        if foul:
            at = draw.randrange(len(lines))
            lines[at] = lines[at] + " You grubbish" + draw.choice(["er", "ing", "ed", "o"]) + " lot."
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(not bad), int(foul), "not this"))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def accuracy(rows, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect()}
    held = [(truth[r.doc_id], r.predicted) for r in rows.collect() if r.held_out]
    assert len(held) > 50
    return np.mean([a == b for a, b in held])


def test_quality_on_held_out_documents(spark):
    docs, labels = corpus(spark)
    rows = quality.quality(docs, labels)
    assert accuracy(rows, labels, "quality") > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows.collect())


def test_toxicity_on_held_out_documents_and_where(spark):
    docs, labels = corpus(spark)
    rows = toxicity.toxicity(docs, labels)
    assert accuracy(rows, labels, "toxic") > 0.95
    text = {r.doc_id: r.text for r in docs.collect()}
    spans = [(r.doc_id, s) for r in rows.collect() if r.predicted for s in r.offending]
    assert spans and np.mean(["grubbish" in text[i][s.start:s.end] for i, s in spans]) > 0.9
    left = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert left == {r.doc_id for r in rows.collect() if not r.predicted}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    z, step = rng.normal(size=4), rng.normal(size=(2, 2))
    good, moves = quality.forward_backward(z, np.array([4]), step)
    weight, paths = np.zeros(16), [[(k >> t) & 1 for t in range(4)] for k in range(16)]
    for k, path in enumerate(paths):
        weight[k] = np.exp(sum(z[t] * path[t] for t in range(4)) + sum(step[path[t], path[t + 1]] for t in range(3)))
    weight /= weight.sum()
    assert np.allclose(good, [sum(w for w, p in zip(weight, paths) if p[t]) for t in range(4)])
    assert np.isclose(moves[0, 1], sum(w * sum(p[t] == 0 and p[t + 1] == 1 for t in range(3)) for w, p in zip(weight, paths)))


def test_noisy_or_equals_its_formula():
    model = toxicity.Model(-1.0, np.zeros(1 << toxicity.BUCKET_BITS))
    _, _, data, offsets = next(pieces(pa.array(["One. Two! Three", ""])))
    p = 1 / (1 + np.exp(1.0))
    assert np.allclose(model.scores(data, offsets), [1 - (1 - p) ** 3, 0.0])


def test_awkward_rows_are_scored_and_nothing_is_lost(spark):
    docs = awkward(spark)
    _, labels = corpus(spark, 40)
    for rows in (quality.quality(docs, labels), toxicity.toxicity(docs, labels)):
        got = rows.collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    none = labels.limit(0)
    assert all(r.score < 0.7 for r in toxicity.toxicity(docs, none).collect())
    assert all(r.score == 0.5 for r in quality.quality(docs, none).collect())
    assert quality.quality(empty(spark), labels).count() == toxicity.toxicity(empty(spark), labels).count() == 0
    labels = spark.createDataFrame([(1, None, None, ""), (None, 1, 1, ""), (2, 1, 0, ""), (2, 1, 0, "")], LABELS)
    assert quality.quality(docs, labels).count() == toxicity.toxicity(docs, labels).count() == docs.count()
