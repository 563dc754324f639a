import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import awkward, empty, words

from swingframe.llm import chat, gru, lm, pieces
from swingframe.llm.words import pieces as cut


def best_path(vocabulary, unknown, text):
    """Highest total score over all segmentations, one position after another."""
    if not text:
        return []
    raw = b" " + text.encode()
    score = {s: (vocabulary.scores[k], k) for k, s in enumerate(vocabulary.spelled) if vocabulary.usable[k] and s}
    most = max(map(len, score))
    marks = [i for i in range(len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]
    best, back = {0: 0.0}, {}
    for before, end in zip(marks, marks[1:]):
        best[end], back[end] = best[before] + unknown, (before, [vocabulary.byte_ids[x] for x in raw[before:end]])
        for start in range(max(0, end - most), end):
            piece = score.get(raw[start:end])
            if piece and start in best and best[start] + piece[0] > best[end]:
                best[end], back[end] = best[start] + piece[0], (start, [piece[1]])
    out, end = [], len(raw)
    while end:
        end, ids = back[end]
        out = ids + out
    return out


def test_pieces_equal_the_best_path_and_decode(spark, folder):
    vocabulary = pieces.Vocabulary.read(pieces.MODEL)
    machine = pieces.automaton(vocabulary)
    texts = [r.text[:300] for r in spark.read.parquet(f"{folder}/documents.parquet").limit(30).collect()]
    texts += ["", " ", "  two  blanks ", "▁ ▁▁x", "日本語🙂", "\n\n\t.", "a" * 300, "\x00 é"]
    _, _, data, offsets = next(cut(pa.array(texts), 1 << 22))
    tokens, ends = pieces.encode_texts(machine, data, offsets)
    for k, text in enumerate(texts):
        assert tokens[ends[k]: ends[k + 1]].tolist() == best_path(vocabulary, machine.unknown, text), text
    assert pieces.decode_tokens(machine, tokens, ends).to_pylist() == texts


def test_awkward_rows_round_trip(spark):
    docs = awkward(spark)
    rows = pieces.encode(docs, ["doc_id", "run"])
    assert rows.count() == docs.count() and rows.filter("NOT round_trip").count() == 0
    assert rows.filter("n_tokens <> size(token_ids)").count() == 0
    back = sorted(((r.doc_id or -1), r.text) for r in pieces.decode(rows, ["doc_id"]).collect())
    assert back == sorted(((r.doc_id or -1), r.text or "") for r in docs.collect())
    assert pieces.encode(empty(spark), ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [0, 1, 2])], "doc_id long, token_ids array<int>")
    assert [r.text for r in pieces.decode(odd, ["doc_id"]).orderBy("doc_id").collect()] == ["", "", ""]


def test_bytes_that_are_no_text_decode_to_replacement(spark):
    vocabulary = pieces.Vocabulary.read(pieces.MODEL)
    row = spark.createDataFrame([(1, [vocabulary.byte_ids[0xFF]])], "doc_id long, token_ids array<int>")
    assert pieces.decode(row, ["doc_id"]).first().text == "�"


def digests(turns):
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha(whole), len(loss), sha(loss)


def test_conversations_come_back(spark):
    draw = random.Random(3)
    parts = ["#", "### ", " ###\n", "\\", "<", "/", "|", "</turn>\n", "<|endoftext|>", "\n", " ", "é", "🙂", "n", "\\n", "語", "word"]
    rows = [(c, k, draw.choice(["user", "assistant", "a\nb#", "", "</x\\n"]), "".join(draw.choice(parts) for _ in range(draw.randint(0, 12))))
            for c in range(120) for k in range(draw.randint(1, 4))]
    rows += [(500, None, None, None), (500, 1, "assistant", None), (None, 1, "assistant", "nameless"),
             (501, 1, "user", "tie b"), (501, 1, "user", "tie a"), (501, 1, "user", "tie a"), (502, 0, "assistant", "long " * 40000)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn int, role string, text string, turns string")
    chats = chat.format_chats(turns)
    want = {}
    for c, k, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chats).collect()}
    assert got == {c: digests(t) for c, t in want.items()}
    assert chat.read_back(chat.format_chats(turns.limit(0))).count() == 0


def test_mask_cuts_tokens_that_cross_a_border():
    starts, ends = np.array([0, 3, 6, 6, 7]), np.array([3, 6, 7, 7, 9])
    spans = [(1, 4), (6, 8), (5, 5)]
    on = chat.mask(starts, ends, spans)
    assert on.tolist() == [True, True, True, True, True]
    assert chat.masked_text("abcdefghi", starts, ends, on, spans) == ["bcd", "gh", ""]


def test_language_model_base_is_exact_and_model_is_better(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").unionByName(awkward(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    got = lm.lm_scores(docs).collect()
    texts = [(r.doc_id, words(r.text) + [None]) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(w for i, t in texts if not held(i) for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted((i or -1, held(i), len(t), sum(count[w] > 0 for w in t),
                   round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 5)) for i, t in texts)
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    for part in (True, False):
        some = [r for r in got if r.held_out == part and r.n_tokens < 20000]
        assert sum(r.score for r in some) > sum(r.base_score for r in some)
    assert lm.lm_scores(empty(spark)).count() == 0


def test_words_outside_the_known_ones_are_joined(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    monkeypatch.setattr(lm, "SAMPLE", 5)
    whole = {r.doc_id: r for r in lm.lm_scores(docs).collect()}
    monkeypatch.setattr(lm, "KNOWN", 4500)
    for r in lm.lm_scores(docs).collect():
        assert math.isclose(r.base_score, whole[r.doc_id].base_score, rel_tol=1e-9) and r.n_known == whole[r.doc_id].n_known


def test_documents_outside_the_first_sample_move_the_weights(spark, monkeypatch):
    monkeypatch.setattr(lm, "SAMPLE", 1)
    monkeypatch.setattr(lm, "LEARNER_TOKENS", 6000)
    monkeypatch.setattr(lm, "MET", 2)  # so that changes meet over several levels
    rng = random.Random(2)
    ordered = ["red green blue " * 30] * 400
    shuffled = [" ".join(rng.sample(t.split(), 90)) for t in ordered]
    gain = []
    for texts in (ordered, shuffled):
        docs = spark.createDataFrame(list(enumerate([*texts, "red green blue " * 30])), "doc_id long, text string").repartition(12)
        rows = [r for r in lm.lm_scores(docs).collect() if r.held_out]
        gain.append(sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows))
    assert gain[0] > 0.2 and gain[0] > gain[1] + 0.15


def test_changes_are_averaged_by_the_tokens_behind_each_weight():
    model, one, two = small_model(), small_model(), small_model()
    one.p["input"][:2] += 1
    two.p["input"][1] += 4
    two.p["start"] += 2
    counts = np.zeros(9)
    changes = [one.change(model, counts + [6, 3, 0, 0, 0, 0, 0, 0, 0]), two.change(model, counts + [0, 1, 2, 0, 0, 0, 0, 0, 0])]
    batches = [b for c in changes for b in [lm.changed(c)]]
    model.move(np.frombuffer(next(lm.added(iter(batches)))["change"][0].as_buffer(), np.float32))
    before = small_model().p
    assert np.allclose(model.p["input"] - before["input"], np.array([1, 1.75, 0, 0, 0, 0, 0, 0, 0])[:, None], atol=1e-6)
    assert np.allclose(model.p["start"] - before["start"], 0.5) and np.array_equal(model.p["word"], before["word"])


def test_rows_are_added_at_repeated_places():
    rng = np.random.default_rng(0)
    at, rows = np.minimum(rng.geometric(0.2, 300), 19), rng.normal(size=(300, 4))
    table, want = np.ones((20, 4)), np.ones((20, 4))
    gru.add_rows(table, at, rows)
    np.add.at(want, at, rows)
    assert np.allclose(table, want)


def small_model():
    model = gru.Model(np.array([50.0, 30, 20, 10, 5, 4, 3, 2]), 6.0)
    rng = np.random.default_rng(0)
    for name in ("class", "word"):
        model.p[name] += rng.normal(size=model.p[name].shape).astype(np.float32) * 0.3
    return model


def test_distribution_adds_up_and_state_is_carried():
    model = small_model()
    history = np.array([1, 4, 8, 0, 2])
    total = 0.0
    base = gru.score(model, history, np.array([0, 5]))[0]
    for word in range(9):
        total += np.exp(gru.score(model, np.append(history, word), np.array([0, 6]))[0] - base)
    assert abs(total - 1) < 1e-4
    many = np.concatenate([history, [3], history])
    assert np.allclose(gru.score(model, many, np.array([0, 5, 6, 11]))[[0, 2]], base, atol=1e-4)


def test_gradient_of_the_output_layer():
    model, rng = small_model(), np.random.default_rng(5)
    h, target = rng.normal(size=(6, gru.HIDDEN)).astype(np.float32) * 0.5, np.array([0, 1, 7, 8, 3, 3])
    grads = {k: np.zeros_like(v) for k, v in model.p.items()}
    back = model.output_gradient(h, target, grads)
    step = 1e-2
    for name, at in (("class", (3, 1)), ("word", (7, 2)), ("class_bias", (2,))):
        old = model.p[name][at]
        model.p[name][at] = old + step
        up = -model.log_likelihood(h, target).mean()
        model.p[name][at] = old - step
        down = -model.log_likelihood(h, target).mean()
        model.p[name][at] = old
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-3
    assert back.shape == h.shape


def test_gradient_of_the_recurrent_weights(monkeypatch):
    model, rng = small_model(), np.random.default_rng(6)
    ids, offsets = rng.integers(0, 9, 24), np.array([0, 3, 11, 12, 24])
    trainer, got = gru.Trainer(model), {}
    monkeypatch.setattr(trainer, "step", lambda grads: got.update({k: g.copy() for k, g in grads.items()}))
    trainer.learn(ids, offsets, 2)
    step = 1e-2
    for name, at in (("state", (4, 3)), ("state", (4, 40)), ("state", (4, 70)), ("start", (50,)), ("start", (90,)),
                     ("input", (int(ids[4]), 5)), ("input", (int(ids[4]), 45)), ("input", (int(ids[4]), 80))):
        old, loss = model.p[name][at], []
        for value in (old + step, old - step):
            model.p[name][at] = value
            loss.append(-gru.score(model, ids, offsets).sum() / len(ids))
        model.p[name][at] = old
        assert abs((loss[0] - loss[1]) / (2 * step) - got[name][at]) < 1e-4


def test_training_asks_for_its_memory_once():
    trainer, rng = gru.Trainer(small_model()), np.random.default_rng(7)
    ids, offsets = rng.integers(0, 9, 400), np.arange(0, 401, 50)
    trainer.learn(ids, offsets, 4)
    held = {k: v.ctypes.data for k, v in (trainer.room.held | trainer.grads).items()}
    trainer.learn(ids[:200], offsets[:5], 4)
    assert {"gates", "states", "rows", "back", "word"} <= set(held)
    assert {k: v.ctypes.data for k, v in (trainer.room.held | trainer.grads).items()} == held


def test_a_task_counts_a_word_once():
    texts = pa.array([f"Same words again {k % 50} " * 2000 for k in range(60)])  # some 3 MB, more than a piece
    rows = [r for b in lm.count_words(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])) for r in b.to_pylist()]
    assert len(rows) == len({r["word"] for r in rows}) == 3 + 50 + 1
    assert sorted(r["c"] for r in rows)[-3:] == [120000] * 3 and sum(r["c"] for r in rows) == 60 * 8000 + 60


def test_known_words_are_found_among_words_of_their_bucket():
    words = np.array([5, 5 + (1 << 40), 5 + (1 << 41), 7, 7 + (1 << 50), 0], np.uint64)
    lookup = lm.Lookup(words)
    asked = np.array([7, 0, 5 + (1 << 41), 6, 5 + (1 << 42), 7 + (1 << 50), 5, 5 + (1 << 40), 1 << 60], np.uint64)
    assert lookup(asked).tolist() == [3, 5, 2, -1, -1, 4, 0, 1, -1]
    assert lm.Lookup(words[:0])(asked).tolist() == [-1] * 9


def test_steps_and_logits_use_the_memory_of_those_before():
    trainer, rng = gru.Trainer(small_model()), np.random.default_rng(8)
    trainer.learn(rng.integers(0, 9, 400), np.arange(0, 401, 50), 4)
    assert {"both", "logits", "total"} <= set(trainer.room.held)


def test_a_large_weight_does_not_overflow():
    model, rng = small_model(), np.random.default_rng(9)
    model.p["word_bias"][1] += 200
    model.p["class_bias"][2] += 300
    h, target = rng.normal(size=(9, gru.HIDDEN)).astype(np.float32) * 0.5, np.arange(9)
    table = model.table(gru.Room()).astype(float)
    logits = np.hstack([h, np.ones((9, 1))]) @ table.T
    logit = lambda rows: logits[:, rows] - np.log(np.exp(logits[:, rows] - logits[:, rows].max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) - logits[:, rows].max(axis=1, keepdims=True)
    top, want = logit(slice(0, model.classes)), []
    for k in target:
        kind = model.kind[k]
        a, b = (model.borders[kind], model.borders[kind + 1]) if kind < model.classes - 1 else (8, 9)
        want.append(top[k, kind] + logit(slice(model.classes + a, model.classes + b))[k, k - a])
    assert np.allclose(model.log_likelihood(h, target), want, rtol=1e-4, atol=1e-3)
    assert np.isfinite(model.output_gradient(h, target, {k: np.zeros_like(v) for k, v in model.p.items()})).all()
