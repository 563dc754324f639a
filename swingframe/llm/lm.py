"""Language-model scores of whole documents.

Words are counted over every training document. The KNOWN most frequent words (a documented
bound) are broadcast with their counts; the others are looked up by a join. The HEAD most
frequent form the vocabulary of a gated recurrent model (``gru``). It starts from truncated
backpropagation over SAMPLE training documents in hash order in the driver, and then learns from
every training document: in each of ROUNDS rounds the documents of one hash class are trained on
where they lie, every task from the same weights, and the tasks' changes are averaged, each weight
by the tokens behind it, over a tree of tasks. Any other word has the probability of the model's last class times its smoothed
share among such words, (c + 0.5) / (N' + 0.5 (V' + 1)), as in the unigram base; so a
document's score is a proper probability of its tokens, whatever their number.

Words are known by 64-bit hashes of their bytes.

Defined results: null counts as empty; an empty text is its end token. A null doc_id belongs
to training. Without training text both scores come from V = N = 0. Repeated rows count as
often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe.llm import gru
from swingframe.llm.labelled import fold
from swingframe.llm.store import written
from swingframe.llm.words import pieces, sums_by, word_hashes

HEAD = 4096
KNOWN = 1 << 18
SAMPLE = 1200
HASHED_AT_ONCE = 1 << 17  # bytes of text whose words are hashed at once, so that the running sums stay in cache
COUNTED_AT_ONCE = 1 << 21  # tokens that a task counts together
TOKENS_AT_ONCE = 1 << 21
ROUNDS = 4
LEARNER_TOKENS = 1 << 22  # training tokens of one task, over all rounds; more tokens, more tasks
LEARNT_AT_ONCE = 1 << 18
LANES = 512  # at most; fewer where there are few tokens, so that STEPS windows come of them
STEPS = 16
MET = 16  # changes that one task adds up
TRAINED_TOGETHER = 1024  # a longer text is trained in parts of so many tokens, so that lanes stay even
END = 0x1E5D_0C0F_7E9A_3B11  # stands for the end of a text


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token, the end of each text included, and the offsets of the texts."""
    words, owner = word_hashes(data, offsets)
    texts = len(offsets) - 1
    ends = np.cumsum(sums_by(owner, None, texts))
    return np.insert(words, ends, np.uint64(END)), np.concatenate([[0], ends + np.arange(1, texts + 1)])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in; words and their counts out, a word once for every COUNTED_AT_ONCE tokens."""
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["word", "c"])

    for batch in batches:
        for _, _, data, offsets in pieces(batch.column(0), HASHED_AT_ONCE):
            held.append(tokens(data, offsets)[0])
            if sum(map(len, held)) >= COUNTED_AT_ONCE:
                yield counted()
    if held:
        yield counted()


class Lookup:
    """Rank of a word among the known ones (-1: unknown), by buckets of the low hash bits."""

    def __init__(self, words: np.ndarray):
        self.bits = int(np.clip(len(words).bit_length() + 3, 10, 20))
        low = self.low(words)
        order = np.argsort(low, kind="stable")
        self.words = np.append(words[order], np.uint64(0))
        self.order = np.append(order, -1).astype(np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(low, minlength=1 << self.bits))]).astype(np.int32)

    def low(self, words: np.ndarray) -> np.ndarray:
        return (words & np.uint64((1 << self.bits) - 1)).view(np.int64)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        low = self.low(words)
        at = self.first.take(low)
        out = np.where(self.words.take(at) == words, self.order.take(at), -1)  # a word of another bucket never equals it
        left = np.flatnonzero(out < 0)
        left = left[at.take(left) + 1 < self.first.take(low.take(left) + 1)]
        while len(left):
            at[left] += 1
            place, own = at.take(left), words.take(left)
            hit = self.words.take(place) == own
            out[left[hit]] = self.order.take(place[hit])
            left = left[~hit & (place + 1 < self.first.take(low.take(left) + 1))]
        return out


class Scorer:
    """Known words in order of frequency with their counts, the recurrent model, and totals."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n: int, v: int):
        self.words, self.counts, self.n, self.v = words, counts, n, v
        self.head = min(HEAD, len(words))
        self.rest = n - int(counts[: self.head].sum())
        self.model = gru.Model(counts[: self.head].astype(float), float(self.rest))
        self.lookup: Lookup | None = None

    def ranks(self, words: np.ndarray) -> np.ndarray:
        if self.lookup is None:
            self.lookup = Lookup(self.words)
        return self.lookup(words)

    def ids(self, ranks: np.ndarray) -> np.ndarray:
        return np.where((ranks >= 0) & (ranks < self.head), ranks, self.head)

    def base_step(self) -> float:
        return float(np.log10(self.n + 0.5 * (self.v + 1)))

    def rest_step(self) -> float:
        return float(np.log10(self.rest + 0.5 * (self.v - self.head + 1)))


def scored(scorer: Scorer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, doc_id, held_out, text in; sums over known words and lists of the others out."""
    log_counts = np.log10(scorer.counts + 0.5)
    base_step, rest_step = scorer.base_step(), scorer.rest_step()
    for batch in batches:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            part = batch.slice(held[0][0], held[-1][1] - held[0][0])
            ids = np.concatenate([x[2] for x in held])
            length = np.concatenate([x[3] for x in held])
            offsets = np.concatenate([[0], np.cumsum(length)])
            likely = gru.score(scorer.model, ids, offsets) / np.log(10)
            base, extra, known = (np.concatenate([x[k] for x in held]) for k in (4, 5, 6))
            words = np.concatenate([x[7] for x in held])
            times = np.concatenate([x[8] for x in held])
            lists = np.concatenate([[0], np.cumsum(np.concatenate([x[9] for x in held]))]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(length), pa.array(known), pa.array(base - length * base_step), pa.array(likely + extra),
                 pa.ListArray.from_arrays(pa.array(lists), pa.array(words.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(lists), pa.array(times))],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "words", "times"])

        for first, last, data, offsets in pieces(batch.column(3), HASHED_AT_ONCE):
            texts = last - first
            hashed, ends = tokens(data, offsets)
            ranks = scorer.ranks(hashed)
            ids = scorer.ids(ranks)
            owner = np.repeat(np.arange(texts), np.diff(ends))
            seen = ranks >= 0
            logs = np.where(seen, log_counts[ranks] if len(log_counts) else 0.0, 0.0)
            rest = ids == scorer.head
            extra = sums_by(owner[rest], logs[rest] - rest_step, texts)
            order = np.lexsort((hashed[~seen], owner[~seen]))
            other, whose = hashed[~seen][order], owner[~seen][order]
            fresh = np.flatnonzero(np.concatenate([[True], (other[1:] != other[:-1]) | (whose[1:] != whose[:-1])])) if len(other) else np.zeros(0, np.int64)
            held.append((first, last, ids, np.diff(ends), sums_by(owner, logs, texts), extra, sums_by(owner[seen], None, texts),
                         other[fresh], np.diff(np.append(fresh, len(other))), sums_by(whose[fresh], None, texts)))
            size += len(ids)
            if size >= TOKENS_AT_ONCE:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()


def parts_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of texts of such lengths, longer ones in parts."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    inner = [np.arange(a, b, TRAINED_TOGETHER) for a, b in zip(ends[:-1], ends[1:])]
    return np.append(np.concatenate(inner), ends[-1])


def learned(scorer: Scorer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts in; one row out, the change of the weights by one pass over all of them."""
    model, lookup = deepcopy(scorer.model), Lookup(scorer.words[: scorer.head])
    trainer, counts = gru.Trainer(model), np.zeros(scorer.head + 1)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def learn() -> None:
        ids = np.concatenate([x[0] for x in held])
        trainer.learn(ids, parts_of(np.concatenate([x[1] for x in held])), int(np.clip(len(ids) // (STEPS * gru.WINDOW), 1, LANES)))
        counts[:] += np.bincount(ids, minlength=len(counts))
        held.clear()

    for batch in batches:
        for _, _, data, offsets in pieces(batch.column(0), HASHED_AT_ONCE):
            hashed, ends = tokens(data, offsets)
            held.append((scorer.ids(lookup(hashed)), np.diff(ends)))
            if sum(len(x[0]) for x in held) >= LEARNT_AT_ONCE:
                learn()
    if held:
        learn()
    if counts.any():
        yield changed(model.change(scorer.model, counts))


def changed(change: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([change.astype(np.float32).tobytes()], pa.binary())], names=["change"])


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column(0):
            change = np.frombuffer(x.as_buffer(), np.float32)
            total = change.astype(np.float64) if total is None else np.add(total, change, out=total)
    if total is not None:
        yield changed(total)


def learn_from_all(scorer: Scorer, docs: DataFrame) -> None:
    """ROUNDS rounds of training, which together pass over every row of docs once."""
    learners = -(-scorer.n // LEARNER_TOKENS)
    for turn in range(ROUNDS):
        texts = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn).select("text").coalesce(learners)
        changes, left = texts.mapInArrow(lambda batches: learned(scorer, batches), "change binary"), learners
        while left > MET:
            left = -(-left // MET)
            changes = changes.repartition(left).mapInArrow(added, "change binary")
        for total in added(changes.toArrow().to_batches()):
            scorer.model.move(np.frombuffer(total["change"][0].as_buffer(), np.float32))


def fit(docs: DataFrame, counts: DataFrame) -> Scorer:
    """docs: doc_id, text of the training rows; counts: word, c over all of them."""
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    step = F.floor(F.log2(F.col("c").cast("double")) * 16)
    sizes = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = None, 0
    for at, n in sizes:  # the known words: whole steps of count, as many as fit the bound
        if total + n > KNOWN:
            break
        least, total = at, total + n
    known = counts.filter(step >= least).toPandas() if least is not None else counts.limit(0).toPandas()
    known = known.sort_values(["c", "word"], ascending=[False, True])
    scorer = Scorer(known["word"].to_numpy(np.int64).view(np.uint64), known["c"].to_numpy(np.int64), int(sums["n"] or 0), int(sums["v"]))
    picked = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").select("text").toArrow()["text"]
    ids, lengths = [], []
    for _, _, data, offsets in pieces(texts.combine_chunks() if texts.num_chunks else pa.array([], pa.string())):
        hashed, ends = tokens(data, offsets)
        ids.append(scorer.ids(scorer.ranks(hashed)))
        lengths.append(np.diff(ends))
    scorer.lookup = None  # each task builds its own
    if scorer.head:
        if ids:
            gru.train(scorer.model, np.concatenate(ids), parts_of(np.concatenate(lengths)))
        learn_from_all(scorer, docs)
    return scorer


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    held_out = fold(F.col("doc_id"), 5) == 1
    training = docs.select("doc_id", "text").filter(~held_out)
    counts = written(training.select("text").mapInArrow(count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    scorer = fit(training, counts)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out.alias("held_out"), "text")
    rows = written(rows.mapInArrow(
        lambda batches: scored(scorer, batches),
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
        "words array<long>, times array<long>"), "lm-rows")
    other = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), "x.times")
    other = other.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"))
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.drop("words", "times").join(other, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(scorer.n).cast("long").alias("train_tokens"), (F.col("base_score") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"))
