"""A gated recurrent language model in numpy with a class-factored output.

The vocabulary is a head of frequent words, each in one class, and one more class for all
other words. A step's distribution is softmax over classes times softmax within the class;
the last class leaves the choice of its word to the caller. Inputs are looked up straight in
gate space. Sequences are packed end to end into lanes; the state is carried from window to
window and set to zero where a sequence starts, so every whole sequence gets its likelihood.

Gates of many tokens are laid out gate by gate, each a whole (tokens, HIDDEN) block, so that arithmetic runs
over unbroken memory; targets are put in the order of their classes once, so that a class is a slice.
Classes and words are rows of one table with their biases, and states get a last column of ones, so that a product
adds the bias. BLOCK targets are taken through all of the output layer before the next.
"""

from __future__ import annotations

import heapq
from math import prod

import numpy as np

HIDDEN, CLASSES, WINDOW = 32, 64, 32
BLOCK = 4096  # targets whose logits are worked on at once
ADAM_AT_ONCE = 1 << 15  # weights that are moved at once
SCORED_AT_ONCE = 1 << 15  # tokens whose gates and states are held while scoring


class Room:
    """Arrays that are filled again in every window, as new memory costs more than the arithmetic on it."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, np.float32)
        return self.held[name][:size].reshape(shape)

    def taken(self, name: str, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        return rows.take(at, axis=0, out=self(name, len(at), rows.shape[1]), mode="clip")


# Input gates are held with these factors, which are exact: the logistic function of x is 1 / (1 + exp(-x)), and
# tanh x is 2 / (1 + exp(-2 x)) - 1. Float32 overflow gives their right limits (callers keep it from warning).
FACTORS = np.array([-1, -1, -2], np.float32).reshape(3, 1, 1)


def by_gate(rows: np.ndarray) -> np.ndarray:
    """Rows of three gates side by side as three blocks, times FACTORS."""
    return np.multiply(rows.reshape(len(rows), 3, HIDDEN).transpose(1, 0, 2), FACTORS, order="C")


def class_borders(counts: np.ndarray, classes: int) -> np.ndarray:
    """First word of each class: words in order of frequency, cut at equal shares of root frequency."""
    if not len(counts):
        return np.zeros(1, np.int64)
    mass = np.cumsum(np.sqrt(counts))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes)
    return np.unique(np.concatenate([[0], cuts, [len(counts)]]))


class Model:
    """Words 0 .. n-1 in order of frequency; word n stands for every other word."""

    def __init__(self, counts: np.ndarray, rest: float, seed: int = 1):
        draw = np.random.default_rng(seed)
        n = len(counts)
        self.borders = class_borders(counts, CLASSES)
        self.classes = len(self.borders)  # the classes of the head, and the rest
        self.kind = np.full(n + 1, self.classes - 1)
        for k in range(self.classes - 1):
            self.kind[self.borders[k]: self.borders[k + 1]] = k
        share = np.bincount(self.kind[:n], counts, minlength=self.classes).astype(float)
        share[-1] = max(rest, 0.5)
        f = np.float32
        inside = np.bincount(self.kind[:n], counts, minlength=self.classes)[self.kind[:n]]
        self.p = {
            "input": (draw.normal(size=(n + 1, 3 * HIDDEN)) * 0.1).astype(f),
            "start": np.zeros(3 * HIDDEN, f),
            "state": (draw.normal(size=(HIDDEN, 3 * HIDDEN)) / np.sqrt(HIDDEN)).astype(f),
            "class": np.zeros((HIDDEN, self.classes), f), "class_bias": np.log(share / share.sum()).astype(f),
            "word": np.zeros((n + 1, HIDDEN), f), "word_bias": np.append(np.log(np.maximum(counts, 0.5) / np.maximum(inside, 0.5)), 0).astype(f),
        }
        self.p["input"][:, :HIDDEN] += 1  # gates begin by keeping the state

    def evidence(self, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Tokens behind each weight, by the tokens of each word: a word's inputs are moved by itself,
        its outputs by its class, all else by every token."""
        whole = np.full(1, counts.sum())
        kind = np.bincount(self.kind, counts, minlength=self.classes)[self.kind]
        return {"input": counts[:, None], "word": kind[:, None], "word_bias": kind} | dict.fromkeys(("start", "state", "class", "class_bias"), whole)

    def change(self, before: Model, counts: np.ndarray) -> np.ndarray:
        """What training on so many tokens of each word moved, times the tokens behind it, and the tokens; such rows can be added."""
        behind = self.evidence(counts)
        return np.concatenate([((self.p[k] - before.p[k]) * behind[k]).ravel() for k in sorted(self.p)] + [counts]).astype(np.float32)

    def move(self, total: np.ndarray) -> None:
        """Take the mean of added changes; what nothing stands behind stays."""
        behind = self.evidence(total[len(total) - len(self.kind):].astype(np.float64))
        first = 0
        for k in sorted(self.p):
            part = total[first: first + self.p[k].size].reshape(self.p[k].shape)
            first += self.p[k].size
            self.p[k] += (part / np.maximum(behind[k], 1)).astype(np.float32)

    @staticmethod
    def advance(gates: np.ndarray, h: np.ndarray, state: np.ndarray, both: np.ndarray, after: np.ndarray) -> None:
        """One step from input gates, states and the state's weights, the first and last ``by_gate``, into ``after``; the
        gates become z, r and the new state, and the last block of ``both`` what r was multiplied by, times its factor."""
        np.matmul(h, state, out=both)
        zr, new = gates[:2], gates[2]
        zr += both[:2]
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        new += np.multiply(gates[1], both[2], out=both[0])
        np.exp(new, out=new)
        new += 1
        np.divide(2, new, out=new)
        new -= 1
        np.subtract(h, new, out=after)
        after *= gates[0]
        after += new

    def sorted_targets(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of targets by class, and in that order the targets and their classes."""
        kind = self.kind.take(target)
        order = np.argsort(kind.astype(np.uint8 if self.classes < 256 else np.int64), kind="stable")
        return order, target.take(order), kind.take(order)

    def table(self, room: Room) -> np.ndarray:
        """Output weights and the bias of every class, then of every word."""
        out, p = room("table", self.classes + len(self.kind), HIDDEN + 1), self.p
        out[: self.classes, :HIDDEN], out[: self.classes, HIDDEN] = p["class"].T, p["class_bias"]
        out[self.classes:, :HIDDEN], out[self.classes:, HIDDEN] = p["word"], p["word_bias"]
        return out

    def outputs(self, h: np.ndarray, target: np.ndarray, table: np.ndarray, room: Room):
        """BLOCK targets after the other, in the order of their classes: which they are, their states and a one, and the
        exponentials of the logits of all classes and, in the classes of several words, of the words."""
        order, target, kind = self.sorted_targets(target)
        ends = np.searchsorted(kind, np.arange(self.classes - 1), "right").tolist()
        groups = [(first, end, self.classes + a, self.classes + b) for first, end, a, b
                  in zip([0, *ends], ends, self.borders.tolist(), self.borders[1:].tolist()) if end > first and b - a > 1]
        for start in range(0, len(order), BLOCK):
            part = slice(start, min(start + BLOCK, len(order)))
            size, states = part.stop - start, room("states and ones", part.stop - start, HIDDEN + 1)
            states[:, :HIDDEN] = room.taken("states in order", h, order[part])
            states[:, HIDDEN] = 1
            blocks = [(max(first - start, 0), min(end - start, size), a, b) for first, end, a, b in groups if first < part.stop and end > start]
            yield order[part], states, Exponentials(states, table, [(0, size, 0, self.classes), *blocks], kind[part], target[part] + self.classes, room)

    def log_likelihood(self, h: np.ndarray, target: np.ndarray, room: Room | None = None) -> np.ndarray:
        """Natural log probability of each target after each state (of its class alone for the rest)."""
        out, room = np.empty(len(h)), room or Room()
        for own, _, at in self.outputs(h, target, self.table(room), room):
            found = at.logit - np.log(at.total, out=at.total)
            out[own] = np.bincount(at.token, found, len(own))
        return out

    def output_gradient(self, h: np.ndarray, target: np.ndarray, grads: dict[str, np.ndarray], room: Room | None = None) -> np.ndarray:
        """Add the output parameters' gradients of the mean loss; return the states' gradient."""
        room = room or Room()
        table = self.table(room)
        out, change = room("back", *h.shape), room("change of the table", *table.shape)
        change.fill(0)
        for own, states, at in self.outputs(h, target, table, room):
            at.flat[at.place] -= at.total  # softmax less the target, times the total
            share = np.reciprocal(at.total * np.float32(len(h)))
            back, done = None, 0
            for (first, end, a, b), logits in zip(at.blocks, at.views):
                logits *= share[done: done + end - first, None]
                done += end - first
                change[a:b] += logits.T @ states[first:end]
                moved = logits @ table[a:b, :HIDDEN]
                if back is None:
                    back = moved
                else:
                    back[first:end] += moved
            out[own] = back
        top, words = change[: self.classes], change[self.classes:]
        for name, part in (("class", top[:, :HIDDEN].T), ("class_bias", top[:, HIDDEN]), ("word", words[:, :HIDDEN]), ("word_bias", words[:, HIDDEN])):
            grads[name] += part
        return out


class Exponentials:
    """Of the logits of blocks (first state, end, first row of the table, end), the first over all states, together in
    ``flat`` and each in ``views``; and of each state in each block its place among the states, the place in ``flat`` and
    the logit of its target, and the total. States lie in (-1, 1), so logits stay far from overflow unless a weight has
    grown large; only then each row's largest logit is taken off."""

    def __init__(self, states: np.ndarray, table: np.ndarray, blocks: list[tuple[int, int, int, int]], kind: np.ndarray, word: np.ndarray, room: Room):
        self.blocks = blocks
        first, end, a, b = np.array(blocks).T
        long, wide = end - first, b - a
        size = long * wide
        ends, done = np.cumsum(size), np.cumsum(long)
        self.flat = room("logits", int(ends[-1]))
        self.views = [self.flat[k - m * n: k].reshape(m, n) for k, m, n in zip(ends.tolist(), long.tolist(), wide.tolist())]
        for (i, j, k, m), view in zip(blocks, self.views):
            np.matmul(states[i:j], table[k:m].T, out=view)
        if float(self.flat.max()) > 60:
            for view in self.views:
                view -= view.max(axis=1, keepdims=True)
        block = np.repeat(np.arange(len(blocks)), long)
        self.token = np.arange(len(block)) + (first - done + long).take(block)
        row = np.concatenate([kind, word.take(self.token[len(kind):])])
        self.place = self.token * wide.take(block) + (ends - size - first * wide - a).take(block) + row
        self.logit = self.flat.take(self.place)
        np.exp(self.flat, out=self.flat)
        self.total, ones = room("total", len(block)), np.ones(int(wide.max()), np.float32)
        for view, k, m in zip(self.views, done.tolist(), long.tolist()):
            np.matmul(view, ones[: view.shape[1]], out=self.total[k - m: k])


def sorted_places(at: np.ndarray, size: int) -> np.ndarray:
    """Order of places below size."""
    return np.argsort(at.astype(np.uint16) if size <= 1 << 16 else at, kind="stable")


def add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """table[at] += rows, with repeated places."""
    order = sorted_places(at, len(table))
    add_sorted(table, at[order], rows[order])


def add_sorted(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """table[at] += rows, with places in order: frequent ones by a product, the others one repeat at a time."""
    first = np.flatnonzero(np.diff(at, prepend=-1))
    times = np.diff(np.append(first, len(at)))
    for k in np.flatnonzero(times > 8):
        table[at[first[k]]] += np.ones(times[k], rows.dtype) @ rows[first[k]: first[k] + times[k]]
    first, times = first[times <= 8], times[times <= 8]
    for turn in range(8):
        more = first[times > turn] + turn
        table[at[more]] += rows[more]


def lanes_of(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Sequences dealt to at most ``most`` lanes of about equal length, longest first."""
    longest = int(lengths.max(initial=1))
    count = int(np.clip(-(-int(lengths.sum()) // longest), 1, most))
    heap = [(0, k) for k in range(count)]
    lanes: list[list[int]] = [[] for _ in range(count)]
    for k in np.argsort(-lengths, kind="stable"):
        load, lane = heap[0]
        lanes[lane].append(int(k))
        heapq.heapreplace(heap, (load + int(lengths[k]), lane))
    return lanes


class Packed:
    """Token sequences end to end in lanes, longest lane first."""

    def __init__(self, tokens: np.ndarray, offsets: np.ndarray, most: int):
        lengths = np.diff(offsets)
        lanes = lanes_of(lengths, most)
        size = np.array([int(lengths[x].sum()) for x in lanes])
        order = np.argsort(-size, kind="stable")
        sequence = np.concatenate([np.array(lanes[k], np.int64) for k in order]) if len(lanes) else np.zeros(0, np.int64)
        self.size = size[order]
        self.base = np.cumsum(self.size) - self.size
        long = lengths[sequence]
        begin = np.cumsum(long) - long
        self.owner = np.repeat(sequence, long)
        self.tokens = tokens[np.arange(len(self.owner)) + np.repeat(offsets[sequence] - begin, long)]
        self.opens = np.zeros(len(self.owner) + 1, bool)
        self.opens[begin] = True
        self.steps = int(self.size[0]) if len(self.size) else 0
        self.alive = np.searchsorted(-self.size, -np.arange(self.steps), "left")

    def window(self, alive: np.ndarray, first: int) -> tuple[np.ndarray, ...]:
        """Places of the tokens of some steps, the tokens before them, where sequences start; of each step its number of
        lanes, its end and whether a sequence starts."""
        ends = np.cumsum(alive)
        step = np.repeat(np.arange(len(alive)), alive)
        at = self.base.take(np.arange(len(step)) - (ends - alive).take(step))
        at += step
        at += first
        opens = self.opens.take(at)
        fresh = np.logical_or.reduceat(opens, ends - alive)
        return at, self.tokens.take(np.maximum(at - 1, 0)), opens, list(zip(alive.tolist(), ends.tolist(), fresh.tolist()))


def look_up(gates: np.ndarray, tables: np.ndarray, start: np.ndarray, seen: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Input gates after each seen token, or of a start."""
    for table, gate in zip(tables, gates):
        table.take(seen, axis=0, out=gate, mode="clip")
    gates[:, opens] = start
    return gates


def score(model: Model, tokens: np.ndarray, offsets: np.ndarray, most: int = 1024) -> np.ndarray:
    """Log-likelihood (natural) of each whole sequence."""
    packed = Packed(tokens, offsets, most)
    total = np.zeros(len(offsets) - 1)
    room, tables, start, state = Room(), by_gate(model.p["input"]), by_gate(model.p["start"][None]), by_gate(model.p["state"])
    h = np.zeros((len(packed.size), HIDDEN), np.float32)
    window = max(1, SCORED_AT_ONCE // max(len(packed.size), 1))
    with np.errstate(over="ignore"):
        for first in range(0, packed.steps, window):
            at, seen, opens, steps = packed.window(packed.alive[first: first + window], first)
            gates, states = look_up(room("gates", 3, len(at), HIDDEN), tables, start, seen, opens), room("states", len(at), HIDDEN)
            both = room("both", 3, steps[0][0], HIDDEN)
            for k, end, fresh in steps:
                span = slice(end - k, end)
                before, h, both = h[:k], states[span], both if both.shape[1] == k else room("both", 3, k, HIDDEN)
                if fresh:
                    before = np.where(opens[span, None], np.float32(0), before)
                model.advance(gates[:, span], before, state, both, h)
            h = h.copy()  # the next window's states come to lie over it
            total += np.bincount(packed.owner[at], model.log_likelihood(states, packed.tokens.take(at), room), len(total))
    return total


class Trainer:
    """Truncated backpropagation through windows of WINDOW steps, by Adam; its moments last over calls."""

    def __init__(self, model: Model, rate: float = 0.004):
        self.model, self.rate, self.turn = model, rate, 0
        self.moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
        self.grads, self.room = {k: np.empty_like(v) for k, v in model.p.items()}, Room()

    def learn(self, tokens: np.ndarray, offsets: np.ndarray, lanes: int = 64) -> None:
        """One pass over the sequences."""
        packed = Packed(tokens, offsets, lanes)
        h = np.zeros((len(packed.size), HIDDEN), np.float32)
        with np.errstate(over="ignore"):
            for first in range(0, packed.steps, WINDOW):
                h = self.window(packed, h, packed.alive[first: first + WINDOW], first)

    def window(self, packed: Packed, h: np.ndarray, alive: np.ndarray, first: int) -> np.ndarray:
        """One step of Adam from the states ``h`` that the window before left."""
        model, grads, room = self.model, self.grads, self.room
        at, seen, opens, steps = packed.window(alive, first)
        tables, start, state = by_gate(model.p["input"]), by_gate(model.p["start"][None]), by_gate(model.p["state"])
        gates = look_up(room("gates", 3, len(at), HIDDEN), tables, start, seen, opens)
        before, states, side = (room(name, len(at), HIDDEN) for name in ("before", "states", "side"))
        both = room("both", 3, int(alive[0]), HIDDEN)
        for k, end, fresh in steps:
            span = slice(end - k, end)
            own, both = before[span], both if both.shape[1] == k else room("both", 3, k, HIDDEN)
            own[:] = h[:k]
            if fresh:
                own[opens[span]] = 0
            h = states[span]
            model.advance(gates[:, span], own, state, both, h)
            np.multiply(both[2], np.float32(-0.5), out=side[span])  # what r was multiplied by
        last = h.copy()  # the next window's states come to lie over it
        for g in grads.values():
            g.fill(0)
        back = model.output_gradient(states, packed.tokens.take(at), grads, room)
        carried = np.zeros((int(alive[0]), HIDDEN), np.float32)
        turned = np.ascontiguousarray(model.p["state"].T).reshape(3, HIDDEN, HIDDEN)
        for k, end, fresh in reversed(steps):
            span = slice(end - k, end)
            own, old, beside, both = gates[:, span], before[span], side[span], both if both.shape[1] == k else room("both", 3, k, HIDDEN)
            z, r, new = own  # become their gradients
            d = back[span]
            d += carried[:k]
            keep = np.multiply(d, z, out=carried[:k])
            d -= keep  # d (1 - z)
            z *= d
            z *= np.subtract(old, new, out=both[0])
            new *= new
            np.subtract(1, new, out=new)
            new *= d
            past = np.subtract(1, r, out=both[0])
            past *= beside
            np.multiply(new, r, out=beside)
            np.multiply(beside, past, out=r)
            keep += np.matmul(z, turned[0], out=both[0])
            keep += np.matmul(r, turned[1], out=both[1])
            keep += np.matmul(beside, turned[2], out=both[2])
            if fresh:
                keep[opens[span]] = 0
        inside = np.flatnonzero(~opens)
        seen = seen.take(inside)
        order = sorted_places(seen, len(grads["input"]))
        rows = room("rows", len(inside), 3 * HIDDEN)
        for k in range(3):
            part = slice(k * HIDDEN, (k + 1) * HIDDEN)
            grads["state"][:, part] = before.T @ (side if k == 2 else gates[k])
            grads["start"][part] = gates[k][opens].sum(axis=0)
            rows[:, part] = room.taken("gate", gates[k], inside.take(order))
        add_sorted(grads["input"], seen.take(order), rows)
        self.step(grads)
        return last

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.turn += 1
        size = float(np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values())))
        scale = np.float32(min(1.0, 1.0 / max(1e-9, size)))
        scale *= np.float32(0.1)
        even = np.sqrt(np.float32(1 - 0.99**self.turn))
        rate = np.float32(self.rate / (1 - 0.9**self.turn)) * even
        least = np.float32(1e-7) * even
        for name, whole in grads.items():
            arrays = [x.reshape(-1) for x in (whole, *self.moment[name], self.model.p[name])]
            for first in range(0, whole.size, ADAM_AT_ONCE):
                g, m, v, p = (x[first: first + ADAM_AT_ONCE] for x in arrays)
                g *= scale
                m *= np.float32(0.9)
                m += g
                g *= g
                v *= np.float32(0.99)
                v += g
                np.sqrt(v, out=g)
                g += least
                np.divide(m, g, out=g)
                g *= rate
                p -= g


def train(model: Model, tokens: np.ndarray, offsets: np.ndarray, epochs: int = 2, rate: float = 0.004, lanes: int = 64) -> Model:
    trainer = Trainer(model, rate)
    for _ in range(epochs):
        trainer.learn(tokens, offsets, lanes)
    return model
