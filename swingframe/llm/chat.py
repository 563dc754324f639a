"""Conversations as one marked text with token ids and a loss mask.

A turn is written as

    ### <role> ###\\n<text></turn>\\n

The three control strings ("### ", " ###\\n", "</turn>\\n") are single tokens added to the
vocabulary. Inside roles and texts a backslash goes before every backslash and ``#``, between ``<``
and ``/`` or ``|``, and in place of a role's line end, so that a control string (or another special token of the
vocabulary) can only come from the template; ``unescaped`` takes the backslashes away again.

A whole conversation is rendered, encoded once with offsets, and its tokens meet the turns by
binary search: both lists of spans are sorted, so the tokens of a turn are those between two
search positions. Loss falls on the texts of ``learned`` roles. As control strings are whole
tokens, no token crosses a text's border; with any other template, ``mask`` marks the tokens
that overlap a turn, and ``masked_text`` cuts them at the turn's border.

A conversation is gathered as one group: its result is one row in any case, and its size is that of
its text. Defined results: a null text or role is empty; turns go by number (null first), ties by
role and text; rows with a null conv_id are one conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
OPEN, HEAD, CLOSE = "### ", " ###\n", "</turn>\n"
LEARNED = ("assistant",)
FORMATTED = ("conv_id {kind}, formatted string, token_ids array<int>, starts array<int>, ends array<int>, "
             "loss_mask array<boolean>, turn_starts array<int>, turn_ends array<int>")


def escaped(text: str) -> str:
    return re.sub(r"[\\#]|<(?=[/|])", lambda m: m[0] + "\\" if m[0] == "<" else "\\" + m[0], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\([\\#n])|<\\(?=[/|])", lambda m: "<" if m[1] is None else "\n" if m[1] == "n" else m[1], text)


def rendered(turns: list[tuple[str, str]], learned: tuple[str, ...]) -> tuple[str, list[tuple[int, int]]]:
    """The marked text of (role, text) turns, and the spans of texts of learned roles."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + escaped(role).replace("\n", "\\n") + HEAD
        body = escaped(text)
        at += len(head)
        if role in learned:
            spans.append((at, at + len(body)))
        at += len(body) + len(CLOSE)
        parts += [head, body, CLOSE]
    return "".join(parts), spans


TURN = re.compile(re.escape(OPEN) + r"(.*?)" + re.escape(HEAD) + r"(.*?)" + re.escape(CLOSE), re.S)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a marked text."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in TURN.finditer(formatted)]


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap a span. Token starts and ends never fall, so each span needs two searches."""
    out = np.zeros(len(starts), bool)
    for first, last in spans:
        if first < last:
            out[np.searchsorted(ends, first, "right"): np.searchsorted(starts, last, "left")] = True
    return out


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, on: np.ndarray, spans: list[tuple[int, int]]) -> list[str]:
    """The marked text under the mask, one string per span, read from token offsets and cut at the span."""
    out = []
    for first, last in spans:
        low, high = np.searchsorted(ends, first, "right"), np.searchsorted(starts, last, "left")
        hit = np.flatnonzero(on[low:high]) + low
        text, at = [], first  # tokens that are parts of one character share its offsets
        for a, b in zip(np.maximum(starts[hit], first), np.minimum(ends[hit], last)):
            if b > at or (b == at and a < b and not text):
                text.append(formatted[max(a, at): b])
                at = int(b)
        out.append("".join(text))
    return out


_LOADED: dict[str, object] = {}


def encoder(spelled: str):
    """A tokenizer from its JSON text, with the control strings as tokens; one per worker."""
    from tokenizers import AddedToken, Tokenizer

    key = hashlib.sha256(spelled.encode()).hexdigest()
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made = Tokenizer.from_str(spelled)
        made.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (OPEN, HEAD, CLOSE)])
        made.no_truncation()
        _LOADED.clear()
        _LOADED[key] = made
    return _LOADED[key]


def format_chats(turns: DataFrame, tokenizer: str = TOKENIZER, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per conversation: marked text, token ids with code point offsets, loss mask, learned spans."""
    with open(tokenizer, encoding="utf-8") as file:
        spelled = file.read()
    shared = turns.sparkSession.sparkContext.broadcast(spelled)  # a vocabulary file, some megabytes at any size of data
    kind = turns.schema["conv_id"].dataType.simpleString()
    groups = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    ready = groups.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(shared.value)
        ints, flags = pa.list_(pa.int32()), pa.list_(pa.bool_())
        for batch in batches:
            for first in range(0, len(batch), 64):
                part = batch.slice(first, 64)
                shown = [rendered(list(zip(r, t)), learned) for r, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                out = []
                for (text, spans), code in zip(shown, made.encode_batch([x[0] for x in shown], add_special_tokens=False)):
                    offsets = np.array(code.offsets, np.int32).reshape(-1, 2)
                    starts, ends = offsets[:, 0].copy(), offsets[:, 1].copy()
                    out.append((text, np.array(code.ids, np.int32), starts, ends, mask(starts, ends, spans),
                                [a for a, _ in spans], [b for _, b in spans]))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(columns[0], pa.string()), *(pa.array(columns[k], ints) for k in (1, 2, 3)),
                     pa.array(columns[4], flags), *(pa.array(columns[k], ints) for k in (5, 6))],
                    names=["conv_id", "formatted", "token_ids", "starts", "ends", "loss_mask", "turn_starts", "turn_ends"])

    return ready.mapInArrow(run, FORMATTED.format(kind=kind))


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of a column as slices of its one buffer of values."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)  # flags are bits, so those are copied
    for a, b in zip(offsets, offsets[1:]):
        yield values[a:b]


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and loss text of formatted conversations, as counts and digests."""
    kind = chats.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = zip(*(lists(batch.column(k)) for k in range(2, 7)))
            for text, (starts, ends, on, first, last) in zip(batch.column(1).to_pylist(), columns):
                turns = parsed(text)
                loss = [unescaped(x) for x in masked_text(text, starts, ends, on, list(zip(first.tolist(), last.tolist())))]
                whole = hashlib.sha256()
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                rows.append((len(turns), whole.hexdigest(), sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest(), len(text)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return chats.select("conv_id", "formatted", "starts", "ends", "loss_mask", "turn_starts", "turn_ends").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
