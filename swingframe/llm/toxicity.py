"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in hashed
features of its words (the word, its first four bytes, its byte 4-grams, all in lower
case); a document's score is their noisy-or, 1 - prod(1 - p). Only document labels are
used: the gradient of the noisy-or decides which sentences of a toxic document take the
blame, so the trained model also says where the offence is.

Training sees at most SAMPLE documents of each class (a documented bound, chosen by
hash order); the FEATURES buckets that best separate the classes get a weight, which
keeps the noise of a long text from adding up. Every whole text is scored.

Defined results: null, empty and wordless texts score 0. Without toxic training rows
everything scores near 0. Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swingframe.llm.labelled import fold, sample, score_rows, trained
from swingframe.llm.store import free_name
from swingframe.llm.words import LETTER, LOWERED, SpanHasher, mix, pieces, runs, sums_by, text_of

SAMPLE = 2500  # labelled documents of each class that training may see
BUCKET_BITS = 18
FEATURES = 1500
THRESHOLD = 0.7
STOPS = np.zeros(256, bool)
STOPS[[0x0A, 0x21, 0x2E, 0x3F]] = True  # line end ! . ?


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence number of every byte, and the text of every sentence. A sentence ends
    after a stop or with its text; each text has at least one."""
    stops = np.concatenate([[0], np.cumsum(STOPS[data])])
    count = np.diff(stops[offsets]) + 1
    owner = np.repeat(np.arange(len(offsets) - 1), count)
    return stops[:-1] + text_of(np.arange(len(data)), offsets), owner


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte position and bucket of every feature, and the starts of all words."""
    low = LOWERED[data]
    starts, ends, _ = runs(LETTER[data], offsets)
    hashed = SpanHasher(low)
    inner = np.flatnonzero(LETTER[data])
    inner = inner[inner + 4 <= np.repeat(ends, ends - starts)]
    long = starts[ends - starts >= 4]
    grams = hashed(inner, inner + 4)
    found = np.concatenate([hashed(starts, ends), mix(hashed(long, long + 4)), mix(~grams)])
    return np.concatenate([starts, long, inner]), (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), starts


class Model:
    """A bias and one weight for each feature bucket."""

    def __init__(self, bias: float, weights: np.ndarray):
        self.bias, self.weights = bias, weights

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sentence number of every byte, text of every sentence, probability of every sentence."""
        number, owner = sentences(data, offsets)
        at, bucket, starts = features(data, offsets)
        hit = np.flatnonzero(self.weights[bucket])
        once = np.unique(number[at[hit]] << BUCKET_BITS | bucket[hit])  # repeats in a sentence add nothing
        logit = self.bias + sums_by(once >> BUCKET_BITS, self.weights[once & (len(self.weights) - 1)], len(owner))
        spoken = sums_by(number[starts], None, len(owner)) > 0
        return number, owner, np.where(spoken, 1 / (1 + np.exp(-np.clip(logit, -40, 40))), 0.0)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        _, owner, p = self.parts(data, offsets)
        return -np.expm1(sums_by(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(offsets) - 1))

    def offences(self, data: np.ndarray, offsets: np.ndarray, least: float) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores, and for each text its sentences of at least ``least``, as code points [start, end)."""
        number, owner, p = self.parts(data, offsets)
        score = -np.expm1(sums_by(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(offsets) - 1))
        found: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        bad = np.flatnonzero(p >= least)
        if len(bad):
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            first, last = np.searchsorted(number, bad, "left"), np.searchsorted(number, bad, "right")
            for s, a, b in zip(bad, first, last):
                start = points[offsets[owner[s]]]
                found[owner[s]].append({"start": int(points[a] - start), "end": int(points[b] - start), "score": float(p[s])})
        return score, found


def train(texts: pa.Array, y: np.ndarray, steps: int = 250, rate: float = 0.15) -> Model:
    """Fit the noisy-or likelihood by Adam over all sentences of the sample."""
    weights = np.zeros(1 << BUCKET_BITS)
    if not len(y) or y.min() == y.max():
        return Model(-12.0 if not len(y) or y.max() == 0 else 12.0, weights)
    seen = np.zeros((2, 1 << BUCKET_BITS))
    for first, last, data, offsets in pieces(texts):
        at, bucket, _ = features(data, offsets)
        pair = np.unique(text_of(at, offsets) << BUCKET_BITS | bucket)
        for k in (0, 1):
            seen[k] += sums_by(pair[y[first:last][pair >> BUCKET_BITS] == k] & ((1 << BUCKET_BITS) - 1), None, 1 << BUCKET_BITS)
    rates = (seen + 0.5) / (np.bincount(y, minlength=2)[:, None] + 1)
    gain = np.abs(rates[1] - rates[0]) * np.abs(np.log(rates[1] / rates[0]))
    chosen = np.sort(np.argsort(-gain, kind="stable")[:FEATURES])
    place = np.full(1 << BUCKET_BITS, -1)
    place[chosen] = np.arange(len(chosen))
    rows, cols, owners, base = [], [], [], 0
    for first, _, data, offsets in pieces(texts):  # a second reading holds the chosen features only
        sentence, owner = sentences(data, offsets)
        at, bucket, starts = features(data, offsets)
        spoken = sums_by(sentence[starts], None, len(owner)) > 0
        hit = np.flatnonzero(place[bucket] >= 0)
        number = np.cumsum(spoken) - 1 + base
        once = np.unique(number[sentence[at[hit]]] << BUCKET_BITS | place[bucket[hit]])
        rows.append(once >> BUCKET_BITS)
        cols.append(once & ((1 << BUCKET_BITS) - 1))
        owners.append(owner[spoken] + first)
        base += int(spoken.sum())
    row, col, owner = np.concatenate(rows), np.concatenate(cols), np.concatenate(owners)
    w, bias = np.zeros(len(chosen)), -4.0
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, w[col], minlength=base), -40, 40)))
        none = np.exp(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)))
        pull = np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0)
        by_sentence = pull[owner] * p
        gradient = np.append(np.bincount(col, by_sentence[row], minlength=len(w)), by_sentence.sum()) / len(y)
        gradient[:-1] += 3e-5 * w
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights[chosen] = w
    return Model(float(bias), weights)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    return trained(sample(docs, labels, "toxic", fold(F.col("doc_id"), 3) != 1, most), train)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences of every row."""
    model = fit(docs, labels)
    spans = T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        scores, found = model.offences(data, offsets, 0.5)
        return [pa.array(scores, pa.float64()), pa.array(found, arrow)]

    rows = score_rows(docs, score, ["doc_id"], [T.StructField("score", T.DoubleType()), T.StructField("offending", spans)])
    return rows.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged; no shuffle."""
    model, names = fit(docs, labels), docs.columns
    clean = free_name(names, "clean")

    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        return [pa.array(model.scores(data, offsets) < THRESHOLD)]

    return score_rows(docs, score, names, [T.StructField(clean, T.BooleanType())]).filter(F.col(clean)).select(*names)
