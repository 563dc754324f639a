"""Quality by a linear-chain conditional random field over lines.

Each line of a text is good or bad. Its emission score is linear in features of itself
and of the lines before and after it; a 2x2 transition table ties neighbours. Exact
forward-backward marginals, weighted by line length in bytes, give the document's score.

Training maximises the chain likelihood on at most SAMPLE documents of each class (a
documented bound, chosen by hash order), every line carrying its document's label. Whole
texts are scored, all documents of a piece side by side, one line position at a time.

Defined results: a null or empty text is one empty line. Without both classes in training
the score is the only class (0.5 without any). Repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swingframe.llm.labelled import fold, sample, score_rows, trained
from swingframe.llm.words import LETTER, LOWERED, SPACE, UPPER, SpanHasher, pieces, runs, sums_by, text_of

SAMPLE = 2000  # labelled documents of each class that training may see
THRESHOLD = 0.3
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
STOP = np.zeros(256, bool)
STOP[[0x2C, 0x2E, 0x27, 0x2D, 0x3A, 0x3B]] = True  # , . ' - : ;
SENTENCE_ENDS = [0x2E, 0x21, 0x3F]  # . ! ?
WIDTH = 3 * 14 + 1


class Lines:
    """Features of the lines of some texts: ``x`` by line, ``text`` and ``size`` by line."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        ends = data == 0x0A
        total = np.concatenate([[0], np.cumsum(ends)])
        self.count = np.diff(total[offsets]) + 1  # lines of each text
        self.text = np.repeat(np.arange(len(offsets) - 1), self.count)
        n = len(self.text)
        line = total[:-1] + text_of(np.arange(len(data)), offsets)
        by = lambda mask: sums_by(line[mask], None, n).astype(float)
        letter, space = LETTER[data], SPACE[data]
        self.size = sums_by(line, None, n) + 1.0
        letters, spaces = by(letter), by(space)
        starts, stops, owner = runs(~space, offsets)
        hashed = SpanHasher(LOWERED[data])(starts, stops)
        number = line[starts]
        words = sums_by(number, None, n).astype(float)
        again = np.zeros(len(starts), bool)
        again[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
        odd = ~letter & ~space & ~DIGIT[data] & ~STOP[data]
        tails = stops - 1
        bare = (stops - starts == 1) & odd[starts]
        final = np.zeros(n)
        final[number] = np.isin(data[tails], SENTENCE_ENDS)  # the last word of a line decides
        pair = np.sort((hashed >> np.uint64(24)) | (number.astype(np.uint64) << np.uint64(40)))
        fresh = np.ones(len(pair), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        different = sums_by((pair[fresh] >> np.uint64(40)).astype(np.int64), None, n)
        full, least = np.maximum(self.size - 1, 1), np.maximum(words, 1)
        self.x = np.stack([
            np.log(self.size) / 5, letters / full, by(UPPER[data]) / np.maximum(letters, 1), by(DIGIT[data]) / full,
            by(odd) / full, spaces / full, np.minimum(letters / least, 30) / 10,
            sums_by(number, again.astype(float), n) / least, sums_by(number, odd[tails].astype(float), n) / least,
            different / least, np.minimum(least / np.maximum(different, 1), 20) / 5, (words <= 3).astype(float),
            sums_by(number, bare.astype(float), n) / least, final,
        ], axis=1)

    def design(self) -> np.ndarray:
        """Features of a line and of its neighbours in the same text, and a constant."""
        before, after = np.zeros_like(self.x), np.zeros_like(self.x)
        same = self.text[1:] == self.text[:-1]
        before[1:][same] = self.x[:-1][same]
        after[:-1][same] = self.x[1:][same]
        return np.concatenate([self.x, before, after, np.ones((len(self.x), 1))], axis=1)


def forward_backward(z: np.ndarray, count: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good for every line, and expected transitions summed over all chains.

    z: log odds of good by line; count: lines of each chain, in order; step: 2x2 log weights."""
    odds = np.exp(np.clip(z, -30, 30))
    emit = np.stack([1 / (1 + odds), odds / (1 + odds)], axis=1)
    order = np.argsort(-count, kind="stable")
    start, length = (np.cumsum(count) - count)[order], count[order]
    table, longest = np.exp(step), int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(longest), "left")  # chains longer than t
    ahead, back = np.empty_like(emit), np.empty_like(emit)
    for t in range(longest):
        at = start[: alive[t]] + t
        a = emit[at] if t == 0 else (ahead[at - 1] @ table) * emit[at]
        ahead[at] = a / a.sum(axis=1, keepdims=True)
    moves = np.zeros((2, 2))
    back[start + length - 1] = 0.5
    for t in range(longest - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        later = emit[at + 1] * back[at + 1]
        b = later @ table.T
        both = ahead[at][:, :, None] * table * later[:, None, :]
        moves += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back[at] = b / b.sum(axis=1, keepdims=True)
    good = ahead * back
    return good[:, 1] / good.sum(axis=1), moves


class Model:
    def __init__(self, weights: np.ndarray, step: np.ndarray):
        self.weights, self.step = weights, step

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        lines = Lines(data, offsets)
        good, _ = forward_backward(lines.design() @ self.weights, lines.count, self.step)
        texts = len(offsets) - 1
        return np.clip(sums_by(lines.text, good * lines.size, texts) / sums_by(lines.text, lines.size, texts), 0, 1)


def train(texts: pa.Array, y: np.ndarray, steps: int = 120, rate: float = 0.1) -> Model:
    """Maximise the chains' log-likelihood by Adam."""
    design, counts = [], []
    for _, _, data, offsets in pieces(texts):
        lines = Lines(data, offsets)
        design.append(lines.design())
        counts.append(lines.count)
    width = WIDTH
    if not len(y) or y.min() == y.max():
        weights = np.zeros(width)
        weights[-1] = 0 if not len(y) else 20 * (2 * y[0] - 1)
        return Model(weights, np.zeros((2, 2)))
    x, count = np.concatenate(design), np.concatenate(counts)
    truth = np.repeat(y, count).astype(float)
    weight_of = np.repeat(1 / count, count)  # a long document counts as much as a short one
    same = np.array([[(1 - y) @ (count - 1), 0], [0, y @ (count - 1)]], float)
    w, step = np.zeros(width), np.zeros((2, 2))
    first, second = np.zeros(width + 4), np.zeros(width + 4)
    for turn in range(1, steps + 1):
        good, moves = forward_backward(x @ w, count, step)
        gradient = np.concatenate([
            x.T @ ((good - truth) * weight_of) / len(y) + 1e-4 * w,
            ((moves - same) / max(1.0, same.sum())).ravel() + 0.02 * step.ravel()])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
        w, step = w - move[:width], step - move[width:].reshape(2, 2)
    return Model(w, step)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = trained(sample(docs, labels, "quality", fold(F.col("doc_id"), 5) != 0, SAMPLE), train)

    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        return [pa.array(model.scores(data, offsets), pa.float64())]

    rows = score_rows(docs, score, ["doc_id"], [T.StructField("score", T.DoubleType())])
    return rows.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
