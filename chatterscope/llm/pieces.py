"""N-best segmentation of texts into the pieces of a SentencePiece vocabulary, and back.

A text is a blank and then its characters, blanks written as ``\\u2581``. The lattice has an
edge for each piece found in it, found by an automaton; a character that no piece covers is
spelled in byte pieces, at a penalty. Forward Viterbi gives the best score of every prefix.
An A-star search that runs backward from the end takes these scores as its heuristic; they are
exact, so it meets complete segmentations in order of score.

Where no piece crosses from one kind of character to another, the lattice of a text falls
apart. Such parts are segmented one by one, and remembered while they are short; the n best
of a text are the best combinations of its parts' n best.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chatterscope.llm.texts import fresh

BLANK = "▁"
# Subtracted from the lowest piece score for each character spelled in bytes (fixed value).
UNKNOWN_PENALTY = 10.0
# Parts that a Python worker remembers, twice as many for a while, and the longest of them.
REMEMBERED = 120_000
SHORT = 48
# Parts whose other segmentations are remembered.
REMEMBERED_OTHERS = 10_000
INFINITE = float("inf")


def cuts(pieces: Iterable[str]) -> list[str]:
    """Ways to cut a text into parts, finest first: letters from signs, at line breaks, at
    blanks, not at all. Whether they cut between two characters depends on these two only.
    """
    signs = {c for p in pieces for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()}
    other = re.escape("".join(sorted(signs)))
    return [
        rf"\n|{BLANK}*(?:[^\W\d_{other}]+|(?:[^{BLANK}\w\n]|[\d_{other}])+)|{BLANK}+",
        rf"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+",
        rf"(?s){BLANK}*[^{BLANK}]+|{BLANK}+",
        r"(?s).+",
    ]


Segmentation = tuple[float, tuple[int, ...]]
# From where, at what score, with which ids.
Edge = tuple[int, float, tuple[int, ...]]
# Best ids as bytes, their score, what the second best costs.
Entry = tuple[bytes, float, float]
# From which id on, how many ids go, what comes instead.
Edit = tuple[int, int, tuple[int, ...]]
_IDS, _SCORE, _GAP = itemgetter(0), itemgetter(1), itemgetter(2)
#: Stands for a blank sign of the text itself, which is spelled in bytes.
LITERAL = "\ue000literal"


class Pieces:
    """The vocabulary of a model file: an automaton of its pieces and its byte pieces."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        self.text: dict[int, str] = {}
        self.bytes: dict[int, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        scores = []
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[i] = int(piece[3:-1], 16)
                self.byte_ids[self.bytes[i]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = piece
                score = model.get_score(i)
                scores.append(score)
                self.automaton.add_word(piece, (len(piece), score, (i,)))
        self.automaton.make_automaton()
        self.single = {t for t in self.text.values() if len(t) == 1}
        ordinary = [s for s in scores if s > -1e8]
        self.lowest = min(ordinary, default=0.0) - UNKNOWN_PENALTY
        raw = {i: t.replace(BLANK, " ").encode() for i, t in self.text.items()}
        raw |= {i: bytes([b]) for i, b in self.bytes.items()}
        # All of them one after another, where each begins and how long it is (-1: no piece).
        self.raw = np.frombuffer(b"".join(raw.values()), np.uint8)
        self.raw_size = np.full(self.size, -1)
        self.raw_size[list(raw)] = [len(x) for x in raw.values()]
        self.raw_begin = np.zeros(self.size, np.int64)
        self.raw_begin[list(raw)] = np.cumsum([0, *map(len, raw.values())])[:-1]
        # The finest cut that goes through no piece.
        self.split = next(
            cut.findall
            for cut in map(re.compile, cuts(self.text.values()))
            if all(cut.findall(t) == [t] for t in self.text.values())
        )
        self.forget()

    def forget(self) -> None:
        self.memory: tuple[dict[str, Entry], dict[str, Entry]] = ({}, {})
        self.searched: dict[tuple[str, int], list[Segmentation]] = {}

    def spelled(self, character: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in character.encode())

    def lattice(self, part: str) -> tuple[list[list[Edge]], list[float]]:
        """Edges (start, score, ids) by their end, and forward Viterbi: each prefix's best score."""
        length = len(part)
        edges: list[list[Edge]] = [[] for _ in range(length + 1)]
        covered = bytearray(length)
        for last, (size, score, ids) in self.automaton.iter(part):
            edges[last + 1].append((last + 1 - size, score, ids))
            if size == 1:
                covered[last] = 1
        best = [0.0] * (length + 1)
        for end in range(1, length + 1):
            here = edges[end]
            if not covered[end - 1]:
                here.append((end - 1, self.lowest, self.spelled(part[end - 1])))
            best[end] = max([best[start] + score for start, score, _ in here])
        return edges, best

    def search(self, part: str, n: int) -> list[Segmentation]:
        """The n best segmentations by a backward A-star search, best first."""
        length = len(part)
        edges, best = self.lattice(part)
        # (what the path is worse than the best, order, position, ids behind it). The heuristic
        # is exact, so each entry stands for a segmentation of just that score: an entry is
        # followed to its end along best edges, the others are put aside, and no more entries
        # than segmentations still wanted need be kept.
        found: list[Segmentation] = []
        open_paths: list[tuple[float, int, int, tuple | None]] = [(0.0, 0, length, None)]
        order = 0
        while open_paths:
            cost, _, at, chain = open_paths.pop(0)
            wanted = n - len(found) - 1
            bar = open_paths[wanted - 1][0] if len(open_paths) >= wanted > 0 else INFINITE
            while at:
                top, on = best[at], None
                for start, score, ids in edges[at]:
                    value = best[start] + score
                    if value == top and on is None:
                        on = (start, ids)
                    elif wanted and cost + top - value < bar:
                        order += 1
                        open_paths.append((cost + top - value, order, start, (ids, chain)))
                at, chain = on[0], (on[1], chain)
            ids: list[int] = []
            while chain is not None:
                ids.extend(chain[0])
                chain = chain[1]
            found.append((best[length] - cost, tuple(ids)))
            open_paths = heapq.nsmallest(wanted, open_paths) if wanted else []
        return found

    def parts_of(self, text: str) -> list[str]:
        """The parts of a text; a blank sign of the text itself is a part of its own, None."""
        first, *others = (" " + text).split(BLANK)
        parts = self.split(first.replace(" ", BLANK))
        for other in others:
            parts.append(LITERAL)
            parts += self.split(other.replace(" ", BLANK))
        return parts

    def entry(self, part: str) -> Entry:
        """What is remembered of a part: its best ids and score, and what the second best costs.

        The heuristic is exact, so that is the least detour from the best path; the search
        itself is only made for the few parts whose others are wanted.
        """
        if part is LITERAL:
            return np.array(self.spelled(BLANK), np.int32).tobytes(), self.lowest, INFINITE
        if self.single.issuperset(part):
            return self.covered_entry(part)
        edges, best = self.lattice(part)
        at, path, gap = len(part), [], INFINITE
        while at:
            top, on = best[at], None
            for start, score, ids in edges[at]:
                detour = top - best[start] - score
                if on is None and best[start] + score == top:
                    on = (start, ids)
                elif detour < gap:
                    gap = detour
            at = on[0]
            path.append(on[1])
        ids = [i for piece in reversed(path) for i in piece]
        return array("i", ids).tobytes(), best[-1], gap

    def covered_entry(self, part: str) -> Entry:
        """``entry`` of a part each of whose characters is a piece, in one pass over the matches.

        Matches come by their end, so the best score of each start is known when it is asked.
        """
        best, steps = [0.0], []
        end, top, second, on = 0, -INFINITE, -INFINITE, None
        for last, piece in self.automaton.iter(part):
            if last != end:
                best.append(top)
                steps.append((on, top - second))
                end, top, second = last, -INFINITE, -INFINITE
            value = best[last + 1 - piece[0]] + piece[1]
            if value > top:
                top, second, on = value, top, piece
            elif value > second:
                second = value
        best.append(top)
        steps.append((on, top - second))
        at, path, gap = len(part), [], INFINITE
        while at:
            (size, _, ids), detour = steps[at - 1]
            if detour < gap:
                gap = detour
            path.append(ids[0])
            at -= size
        path.reverse()
        return array("i", path).tobytes(), top, gap

    def others(self, part: str, n: int) -> list[Segmentation]:
        """The n best segmentations of a part without the first, remembered of short parts."""
        found = self.searched.get((part, n))
        if found is None:
            found = self.search(part, n)[1:]
            if len(part) <= SHORT:
                if len(self.searched) >= REMEMBERED_OTHERS:
                    self.searched.clear()
                self.searched[part, n] = found
        return found

    def entries(self, parts: list[str]) -> list[Entry]:
        young, old = self.memory
        if len(young) > REMEMBERED:
            # What was not asked for since the last change is forgotten.
            young, old = self.memory = ({}, young)
        found = list(map(young.get, parts))
        if None in found:
            for i, entry in enumerate(found):
                if entry is None:
                    part = parts[i]
                    entry = young.get(part) or old.get(part)
                    if entry is None:
                        entry = self.entry(part)
                    if part is not LITERAL and len(part) <= SHORT:
                        young[part] = entry
                    found[i] = entry
        return found

    def encode(self, text: str, n: int) -> tuple[np.ndarray, list[float], list[list[Edit]]]:
        """Best ids, the n best scores, and each other segmentation as edits of the best."""
        parts = self.parts_of(text)
        entries = self.entries(parts)
        ids = np.frombuffer(b"".join(map(_IDS, entries)), np.int32)
        score = float(sum(map(_SCORE, entries)))
        # Only the n - 1 parts that are cheapest to change can differ in the n best. A part
        # whose others cost without end has none.
        gaps = np.fromiter(map(_GAP, entries), float, len(entries))
        chosen: list[int] = []
        for _ in range(min(n - 1, len(gaps))):
            least = int(gaps.argmin())
            if gaps[least] == INFINITE:
                break
            chosen.append(least)
            gaps[least] = INFINITE
        others = {j: self.others(parts[j], n) for j in sorted(chosen)}
        ways: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        for j, found in others.items():
            more = [
                (cost + entries[j][1] - other, (*changes, (j, k)))
                for cost, changes in ways
                for k, (other, _) in enumerate(found)
            ]
            ways = heapq.nsmallest(n, ways + more)
        edits = []
        if len(ways) > 1:
            begin = {j: sum(map(len, map(_IDS, entries[:j]))) // 4 for j in others}
            edits = [
                [(begin[j], len(entries[j][0]) // 4, others[j][k][1]) for j, k in changes]
                for _, changes in ways[1:]
            ]
        return ids, [score - cost for cost, _ in ways], edits

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids: pieces and bytes joined, the blank in front left out."""
        size = self.raw_size[ids]
        if len(ids) and (size.min() < 0 or ids.min() < 0):
            raise KeyError("an id that is no piece")
        shift = self.raw_begin[ids] - np.cumsum(size) + size
        raw = self.raw[np.repeat(shift, size) + np.arange(size.sum())].tobytes()
        return raw[raw[:1] == b" " :].decode("utf-8", "replace")


def apply_edits(ids: np.ndarray, edits: list[Edit]) -> np.ndarray:
    """The segmentation that differs from the best one by ``edits``."""
    out, at = [], 0
    for first, drop, new in sorted(edits):
        out += [ids[at:first], np.array(new, np.int32)]
        at = first + drop
    return np.concatenate([*out, ids[at:]])


# Best ids, the n best scores, each other segmentation as edits of the best.
Encoded = tuple[np.ndarray, list[float], list[list[Edit]]]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def segmented(texts: pa.Array, path: str, n: int) -> Iterator[tuple[int, str, Encoded]]:
    """(row, text, segmentations) of each text; a null one is empty."""
    pieces = load(path)
    for i, text in enumerate(texts):
        whole = text.as_py() or ""
        yield i, whole, pieces.encode(whole, n)


SCHEMA = (
    "{} array<int>, {} array<double>, "
    "{} array<array<struct<first: int, drop: int, ids: array<int>>>>"
)
_EDIT = pa.list_(
    pa.list_(
        pa.struct([("first", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])
    )
)


def encode(
    documents: DataFrame,
    path: str,
    n: int = 3,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The columns ``keep``, then the ``n`` best segmentations of each row's whole text.

    ids is the best one; scores has the score of each, best first; alternatives has the
    others as edits of the best (from piece ``first`` on, ``drop`` pieces give way to
    ``ids``). A text has fewer than n where there are no more. A null text is empty; an
    empty text is the blank in front alone. Equal scores rank by the search's order, which
    depends on the text only, so repeated rows get the same. An empty table gives no rows.
    Where a kept column is called ids, scores or alternatives, the result's name has an
    underscore more.
    """
    columns = keep if text in keep else (*keep, text)
    place, at = columns.index(text), len(keep)
    results = [fresh(name, list(keep)) for name in ("ids", "scores", "alternatives")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from encoded(batches)
        finally:
            # The worker goes on to other work.
            load(path).forget()

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, scores, others, size, begin = [], [], [], 0, 0
            for row, whole, (best, points, edits) in segmented(batch.column(place), path, n):
                ids.append(best)
                scores.append(points)
                others.append([[{"first": a, "drop": d, "ids": i} for a, d, i in e] for e in edits])
                size += len(whole)
                if size < OUTPUT_CHARS and row + 1 < batch.num_rows:
                    continue
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                joined = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(begin, row + 1 - begin) for c in batch.columns[:at]],
                        joined,
                        pa.array(scores, pa.list_(pa.float64())),
                        pa.array(others, _EDIT),
                    ],
                    [*batch.schema.names[:at], *results],
                )
                ids, scores, others, size, begin = [], [], [], 0, row + 1

    return documents.select(*columns).mapInArrow(
        run, _ddl(documents, keep) + SCHEMA.format(*results)
    )


# Characters whose pieces go into one output batch.
OUTPUT_CHARS = 1 << 20


def decode(
    encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded"
) -> DataFrame:
    """All columns but ``ids``, and the text that ``ids`` spell; null ids give a null text.

    ``decode`` of the ids of any segmentation of a text is that text. Where another column is
    called like the result, the result's name has an underscore more.
    """
    keep = tuple(c for c in encoded.columns if c != ids)
    at = len(keep)
    text = fresh(text, list(keep))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            lists = batch.column(at)
            texts = [
                pieces.decode(lists[i].values.to_numpy()) if lists[i].is_valid else None
                for i in range(len(lists))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(texts, pa.string())],
                [*batch.schema.names[:at], text],
            )

    return encoded.select(*keep, ids).mapInArrow(run, f"{_ddl(encoded, keep)}{text} string")


def _ddl(df: DataFrame, columns: tuple[str, ...]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return "".join(f"`{c}` {types[c]}, " for c in columns)
