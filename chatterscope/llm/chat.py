"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its
assistant turns are intersected with the token spans by binary search. A token that reaches
over the edge of a turn counts with the characters that lie inside.

Template: ``<s>[INST]role\\ntext[/INST]</s>`` for a turn to be read, ``<s>role\\ntext</s>`` for an
assistant turn. A control string inside a role or text gets a backslash after its first
character, one more where there are some already, so ``parse`` gives back exactly what went in.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"
ROLE_END = "\n"
# Turns that a task holds as Python strings beside the conversation they belong to.
PART_ROWS = 256

# What may not stand unescaped in a role or text (fixed values).
_CONTROL = re.compile(r"<\\*(?=/?s>|</?SYS>>)|\[\\*(?=/?INST\])")
_ESCAPED = re.compile(r"<\\+(?=/?s>|</?SYS>>)|\[\\+(?=/?INST\])")
_TURN = re.compile(r"<s>(\[INST\])?([^\n]*)\n(.*?)(?(1)\[/INST\])</s>", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the sorted spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        learned = role == LEARNED_ROLE
        body = escape(text)
        head = f"<s>{'' if learned else '[INST]'}{escape_role(role)}{ROLE_END}"
        tail = "</s>" if learned else "[/INST]</s>"
        if learned and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted conversation."""
    return [(unescape_role(m[2]), unescape(m[3])) for m in _TURN.finditer(formatted)]


def token_mask(
    starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mask, first, last): whether a token has characters in a span, and which.

    Token spans are sorted; a token can touch several spans only if they are adjacent, and
    then counts from the first to the last of them.
    """
    if not spans or len(starts) == 0:
        nothing = np.zeros(len(starts), np.int64)
        return np.zeros(len(starts), bool), nothing, nothing
    left, right = np.array(spans, np.int64).T
    near = np.searchsorted(right, starts, side="right")
    inside = np.minimum(near, len(left) - 1)
    mask = (near < len(left)) & (left[inside] < ends) & (ends > starts)
    to = np.searchsorted(left, ends, side="left") - 1
    first = np.where(mask, np.maximum(starts, left[inside]), 0)
    last = np.where(mask, np.minimum(ends, right[np.maximum(to, 0)]), 0)
    return mask, first, last


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file; loaded once per Python worker."""

    path: str

    def load(self):
        return _loaded(self.path)


@lru_cache(maxsize=2)
def _loaded(path: str):
    from tokenizers import Tokenizer as Library

    loaded = Library.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


SCHEMA = (
    "conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, "
    "loss array<boolean>, loss_spans array<struct<first: int, last: int>>"
)


def _formatted(batch: list[tuple[int | None, list[tuple[str, str]]]], library) -> pa.RecordBatch:
    rendered = [render(turns) for _, turns in batch]
    columns: dict[str, list] = {k: [] for k in ("ids", "starts", "ends", "loss", "loss_spans")}
    for text, spans in rendered:
        code = library.encode(text, add_special_tokens=False)
        offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
        mask, first, last = token_mask(offsets[:, 0], offsets[:, 1], spans)
        columns["ids"].append(np.array(code.ids, np.int32))
        columns["starts"].append(offsets[:, 0].astype(np.int32))
        columns["ends"].append(offsets[:, 1].astype(np.int32))
        columns["loss"].append(mask)
        pairs = np.stack([first[mask], last[mask]], 1)
        # Tokens that share one character carry the same span: one is enough.
        keep = np.ones(len(pairs), bool)
        keep[1:] = (pairs[1:] != pairs[:-1]).any(1)
        columns["loss_spans"].append(pairs[keep])
    lists = {k: _list(columns[k], t) for k, t in (("ids", pa.int32()), ("starts", pa.int32()), ("ends", pa.int32()), ("loss", pa.bool_()))}
    pairs = np.concatenate(columns["loss_spans"]).astype(np.int32)
    spans = pa.ListArray.from_arrays(
        _offsets(columns["loss_spans"]),
        pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["first", "last"]),
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array([c for c, _ in batch], pa.int64()),
            pa.array([t for t, _ in rendered], pa.string()),
            *lists.values(),
            spans,
        ],
        ["conv_id", "formatted", *lists, "loss_spans"],
    )


def _offsets(parts: list[np.ndarray]) -> pa.Array:
    return pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())


def _list(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(_offsets(parts), pa.array(np.concatenate(parts), kind))


def format_conversations(conversations: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): text, tokens, mask, spans.

    Turns are in the order of (turn, role, text), nulls first, a repeated row being a turn
    of its own. A null role or text is empty; rows without conv_id form one conversation
    with a null id. An empty table gives no row. Other columns are not read. A conversation
    is rendered and encoded as one text, so it must fit into one task; it is streamed there
    in order, never sorted in memory.
    """
    rows = (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = tokenizer.load()
        current, turns, done, size = None, [], [], 0
        parts = (b.slice(i, PART_ROWS) for b in batches for i in range(0, b.num_rows, PART_ROWS))
        for part in parts:
            for conv, role, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if turns and conv != current:
                    done.append((current, turns))
                    turns = []
                    if size > 200_000:
                        yield _formatted(done, library)
                        done, size = [], 0
                current = conv
                turns.append((role, text))
                size += len(text)
        if turns:
            done.append((current, turns))
        if done:
            yield _formatted(done, library)

    return rows.mapInArrow(run, SCHEMA)


def text_under(formatted: str, spans: Iterable[tuple[int, int]]) -> str:
    """The characters of the sorted spans, each once, unescaped turn by turn."""
    runs: list[list[int]] = []
    for first, last in spans:
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return "".join(unescape(formatted[a:b]) for a, b in runs)
