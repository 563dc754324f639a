"""SentencePiece vocabularies: encoding by Aho-Corasick and Viterbi, and decoding.

The pieces of a model file are the patterns of one Aho-Corasick automaton over bytes. A
single pass over a text keeps the automaton's state; at every position the output links
list the pieces that end there, and each of them relaxes the best score of that position.
The best path is the segmentation of the highest total piece score; of equal scores, the one
whose last piece is longer. A character that no path of pieces covers becomes its bytes'
tokens, for a score below any piece's.

No piece holds a blank after another character, so words can be cut apart without changing
the best path; where a vocabulary has such pieces, whole texts are passed instead. The pass
runs over all different words of a batch side by side, one byte position at a time, so numpy
does the relaxing and repeated words cost one lookup.

A text gets one leading blank, as the vocabulary's own encoder does; decoding takes it away.
A literal U+2581 goes through byte tokens, so decoding returns every text exactly. Null and
empty texts have no tokens. The path of the model file is a parameter; the file is read by the
driver, and tasks get its pieces (some hundred kilobytes) and build their automaton once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swingframe.llm.words import SpanHasher
from swingframe.llm.words import pieces as cut

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
BLANK = 0x20
FALLBACK = -2  # marks a character given as its bytes


class Vocabulary:
    """Pieces (as bytes, U+2581 as a blank), scores, and the token of each byte."""

    def __init__(self, spelled: list[bytes], scores: list[float], usable: list[bool], byte_ids: list[int]):
        self.spelled, self.scores, self.usable, self.byte_ids = spelled, scores, usable, byte_ids
        self.key = hash((tuple(spelled), tuple(scores)))

    @staticmethod
    def read(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled, scores, usable, byte_ids = [], [], [], [-1] * 256
        for k in range(model.get_piece_size()):
            name = model.id_to_piece(k)
            plain = not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k) or model.is_byte(k))
            if model.is_byte(k):
                byte_ids[int(name[3:5], 16)] = k
                spelled.append(bytes([int(name[3:5], 16)]))
            else:
                spelled.append(name.replace("▁", " ").encode() if plain else b"")
            scores.append(model.get_score(k))
            usable.append(plain)
        if min(byte_ids) < 0:
            raise ValueError("the vocabulary has no token for some byte")
        return Vocabulary(spelled, scores, usable, byte_ids)


class Automaton:
    """Dense transitions, output links, and the piece that ends in each state."""

    def __init__(self, words: Vocabulary):
        patterns = [(s, k) for k, s in enumerate(words.spelled) if words.usable[k] and s]
        used = np.zeros(256, bool)
        used[list(set(b"".join(s for s, _ in patterns)))] = True
        self.column = np.where(used, np.cumsum(used), 0).astype(np.int64)  # column 0: bytes of no piece
        children: list[dict[int, int]] = [{}]
        ends, depth = {}, [0]
        for spelled, k in patterns:
            state = 0
            for byte in spelled:
                after = children[state].get(byte)
                if after is None:
                    after = children[state][byte] = len(children)
                    children.append({})
                    depth.append(depth[state] + 1)
                state = after
            ends[state] = k
        n = len(children)
        parent, via = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for state, below in enumerate(children):
            for byte, after in below.items():
                parent[after], via[after] = state, self.column[byte]
        self.next = np.zeros((n, int(used.sum()) + 1), np.int32)
        self.token, self.size, self.score = np.full(n, -1, np.int32), np.zeros(n, np.int64), np.zeros(n)
        for state, k in ends.items():
            self.token[state], self.score[state] = k, words.scores[k]
        depth_of = np.array(depth)
        self.size[:] = depth_of
        self.link = np.zeros(n, np.int32)  # the longest proper suffix that is a piece; 0: none
        fail = np.zeros(n, np.int64)
        for level in range(1, int(depth_of.max(initial=0)) + 1):
            here = np.flatnonzero(depth_of == level)
            if level > 1:
                fail[here] = self.next[fail[parent[here]], via[here]]
            # a level's own edges are laid only after its suffixes are known
            self.next[parent[here], via[here]] = here
            self.link[here] = np.where(self.token[fail[here]] >= 0, fail[here], self.link[fail[here]])
            if level < depth_of.max():
                inner = here
                self.next[inner] = self.next[fail[inner]]
        self.unknown = min((words.scores[k] for _, k in patterns), default=0.0) - 10
        self.byte_ids = np.array(words.byte_ids, np.int32)
        crossing = any(s[i] == BLANK and s[i - 1] != BLANK for s, _ in patterns for i in range(1, len(s)))
        self.alone = ~used & (np.arange(256) < 0x80)  # ASCII bytes of no piece stand alone
        self.cuts = not crossing
        spelled = [s if words.usable[k] or k in set(words.byte_ids) else b"" for k, s in enumerate(words.spelled)]
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.at = np.cumsum(self.length) - self.length


_BUILT: dict[int, Automaton] = {}


def automaton(words: Vocabulary) -> Automaton:
    if words.key not in _BUILT:
        _BUILT.clear()
        _BUILT[words.key] = Automaton(words)
    return _BUILT[words.key]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] numbers, then from starts[1], and so on."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def best_paths(machine: Automaton, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of every given span, one after another, and how many each has."""
    order = np.argsort(-sizes, kind="stable")
    start, size = starts[order], sizes[order]
    base = np.cumsum(size + 1) - (size + 1)
    cells = int((size + 1).sum())
    best, via = np.full(cells, -np.inf), np.full(cells, FALLBACK, np.int32)
    best[base] = 0.0
    back = np.zeros(cells, np.int32)
    state, opened = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), "left")
    follow = np.append((data & 0xC0) == 0x80, False)
    for i in range(longest):
        k = alive[i]
        at = start[:k] + i
        byte = data[at]
        state[:k] = machine.next[state[:k], machine.column[byte]]
        opened[:k] = np.where(follow[at], opened[:k], i)
        cell = base[:k] + i + 1
        # a whole character as bytes
        closed = np.flatnonzero(~follow[at + 1] | (size[:k] == i + 1))
        best[cell[closed]] = best[base[closed] + opened[closed]] + machine.unknown
        back[cell[closed]] = i + 1 - opened[closed]
        here = np.where(machine.token[state[:k]] >= 0, state[:k], machine.link[state[:k]])
        lane = np.flatnonzero(here)
        here = here[lane]
        while len(lane):
            to, long = cell[lane], machine.size[here]
            score = best[to - long] + machine.score[here]
            better = score > best[to]
            won = to[better]
            best[won], via[won], back[won] = score[better], machine.token[here[better]], long[better]
            here = machine.link[here]
            lane, here = lane[here > 0], here[here > 0]
    # walk back from every end; each step yields one piece or one character
    lane, position = np.arange(len(start)), size.copy()
    found = []
    while len(lane):
        cell = base[lane] + position
        long = back[cell]
        found.append((lane, position - long, via[cell], long))
        position = position - long
        lane, position = lane[position > 0], position[position > 0]
    if not found:
        return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
    lane, first, token, long = (np.concatenate(x) for x in zip(*found))
    whole = token != FALLBACK
    width = np.where(whole, 1, long)
    rows = np.repeat(np.arange(len(lane)), width)
    step = spread(np.zeros(len(width), np.int64), width)
    ids = np.where(whole[rows], token[rows], machine.byte_ids[data[start[lane[rows]] + first[rows] + step]])
    owner = order[lane[rows]]
    placed = np.argsort(owner * (longest + 1) + first[rows] + step, kind="stable")
    return ids[placed].astype(np.int32), np.bincount(owner, minlength=len(starts))


def encode_texts(machine: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, one after another, and the offsets of each text's."""
    spoken = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][spoken], BLANK)
    offsets = offsets + np.concatenate([[0], np.cumsum(spoken)])
    head = np.zeros(len(data) + 1, bool)
    head[offsets] = True
    if machine.cuts:
        blank = data == BLANK
        alone = machine.alone[data] & ~blank
        head[1:-1] |= (blank[1:] & ~blank[:-1]) | alone[1:] | alone[:-1]
    starts = np.flatnonzero(head[:-1])
    sizes = np.diff(np.append(starts, len(data)))
    hashed = SpanHasher(data)(starts, starts + sizes)
    _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
    ids, count = best_paths(machine, data, starts[first], sizes[first])
    begin = np.cumsum(count) - count
    tokens = ids[spread(begin[which], count[which])]
    ends = np.concatenate([[0], np.cumsum(count[which])])
    return tokens, ends[np.searchsorted(starts, offsets)]


def decode_tokens(machine: Automaton, tokens: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of token lists; the leading blank goes, and bytes that are no UTF-8 become U+FFFD."""
    size = machine.length[tokens]
    letters = machine.letters[spread(machine.at[tokens], size)]
    ends = np.concatenate([[0], np.cumsum(size)])[offsets]
    first = ends[:-1][(np.diff(ends) > 0)]
    lead = np.zeros(len(letters) + 1, bool)
    lead[first] = True
    lead[:-1] &= letters == BLANK
    gone = np.concatenate([[0], np.cumsum(lead)])
    letters, ends = letters[~lead[:-1]], ends - gone[ends]
    made = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(letters.tobytes()))
    try:
        made.validate(full=True)
    except pa.ArrowInvalid:
        raw = letters.tobytes()
        made = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])], pa.large_string())
    return made


def encode(docs: DataFrame, keep: list[str], model: str = MODEL) -> DataFrame:
    """``keep`` columns of every row, token_ids, n_tokens, and round_trip: whether decoding gives the text back."""
    words = Vocabulary.read(model)
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("round_trip", T.BooleanType())])
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(words)
        for batch in batches:
            for first, last, data, offsets in cut(batch.column(width), BATCH_BYTES):
                tokens, ends = encode_texts(machine, data, offsets)
                part = batch.slice(first, last - first)
                text = pc.fill_null(part.column(width).cast(pa.large_string()), "")
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tokens)),
                     pa.array(np.diff(ends).astype(np.int32)), pc.equal(decode_tokens(machine, tokens, ends), text)], names=schema.names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def decode(rows: DataFrame, keep: list[str], column: str = "token_ids", model: str = MODEL) -> DataFrame:
    """``keep`` columns and the text of every row's token list; null counts as no tokens."""
    words = Vocabulary.read(model)
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("text", T.StringType())])
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(words)
        for batch in batches:
            lists = pc.fill_null(batch.column(width), pa.scalar([], pa.list_(pa.int32()))) \
                if batch.column(width).null_count else batch.column(width)
            ends = lists.offsets.to_numpy().astype(np.int64)
            tokens = lists.values.to_numpy(zero_copy_only=False)[ends[0]: ends[-1]].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], decode_tokens(machine, tokens, ends - ends[0]).cast(pa.string())], names=schema.names)

    return rows.select(*keep, F.col(column).cast("array<int>").alias("__ids")).mapInArrow(run, schema)
