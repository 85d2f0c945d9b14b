"""Repeated passages of words: recurring phrases, found everywhere by automata, judged by window.

Every window of ``window`` words has a least phrase, the ``phrase`` consecutive words of least
hash in it. Equal windows have equal least phrases, so that of a window that recurs recurs.

1. The least phrases of all windows of all documents are counted; those of several texts, or
   of several places in one, are confirmed to recur.
2. Documents go, with the confirmed phrases that concern them, to tasks. A shard is a block of
   documents: a task writes out the words of the block's phrases, compiles them into an
   Aho-Corasick automaton, and streams the block's texts through it.
3. The automaton's hits, and nothing else, say which windows are judged: a window goes by the hit
   of least hash in it, a window without a hit is no repeat. A unit is a run of windows that go
   by one hit. Units meet by phrase, in order of document and place; a window is a repeat
   if an equal one came before.

Two equal windows hold the same hits in all that matters: their least phrase is confirmed and
concerns both documents, and no other hit can be less.

Documents of equal text are one, as all windows but the first document's are repeats.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatterscope.llm import texts
from chatterscope.llm.rows import doc_id, keyed, leads, packed, unpacked, with_runs


@dataclass(frozen=True)
class Rule:
    """Windows of ``window`` words are judged, by phrases of ``phrase`` words."""

    window: int = 20
    phrase: int = 8


@dataclass
class Choice:
    """Windows of some texts: start word, text, and the place of the phrase they go by."""

    start: np.ndarray
    text: np.ndarray
    place: np.ndarray
    phrases: np.ndarray


NO_HIT = np.uint64((1 << 64) - 1)


def choose(phrases: np.ndarray, offsets: np.ndarray, rule: Rule) -> Choice:
    """Let every window of words go by the leftmost of its least phrases.

    ``phrases`` has a hash for each word that a phrase may begin at, or NO_HIT; windows of
    none are left out.
    """
    reach = rule.window - rule.phrase
    n = len(phrases) - reach
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Choice(none, none, none, phrases)
    best, shift = phrases[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, reach + 1):
        other = phrases[j : j + n]
        better = other < best
        np.copyto(best, other, where=better)
        shift[better] = j
    owner = texts.owners(offsets)
    inside = owner[:n] == owner[rule.window - 1 : rule.window - 1 + n]
    start = np.flatnonzero(inside & (best != NO_HIT))
    return Choice(start, owner[start], start + shift[start], phrases)


def _phrases(rows: DataFrame, rule: Rule) -> DataFrame:
    """(phrase, digest, n): the chosen phrases of each text, once per task and text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            digests = batch.column(0).to_numpy()
            for row, end, data, offsets in texts.chunks(batch.column(1)):
                found = texts.words(data, offsets)
                phrases = texts.windows(found.hashes, rule.phrase)
                chosen = choose(phrases, found.offsets, rule)
                new = np.zeros(end - row, bool)
                for i, digest in enumerate(digests[row:end].tolist()):
                    new[i] = digest not in seen
                    seen.add(digest)
                mine = new[chosen.text]
                place, first = np.unique(chosen.place[mine], return_index=True)
                if not len(place):
                    continue
                text = chosen.text[mine][first]
                phrase = chosen.phrases[place]
                order = np.lexsort((phrase, text))
                phrase, text = phrase[order], text[order]
                begin = np.ones(len(order), bool)
                begin[1:] = (phrase[1:] != phrase[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(phrase[at].view(np.int64)),
                        pa.array(digests[row:end][text[at]]),
                        pa.array(np.diff(np.append(at, len(order))).astype(np.int32)),
                    ],
                    ["phrase", "digest", "n"],
                )

    return rows.select("digest", "text").mapInArrow(run, "phrase long, digest long, n int")


def _units(whole: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(phrase, unit, id, digest, start, n, windows) of all occurrences of recurring phrases."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            recurring = batch.column(3)
            column = pa.array(unpacked(batch.column(2)), pa.large_binary())
            for row, end, data, offsets in texts.chunks(column):
                found = texts.words(data, offsets)
                phrases = np.unique(
                    np.concatenate([recurring[i].values.to_numpy() for i in range(row, end)])
                ).view(np.uint64)
                automaton = compiled(data, found, np.sort(phrases), rule)
                hits = located(data, found, automaton, rule)
                out = _unit_batch(found, hits, rule, ids[row:end], digests[row:end])
                if out is not None:
                    yield out

    joined = whole.join(wanted, ["id", "digest"]).select("id", "digest", "packed", "phrases")
    return joined.mapInArrow(
        run,
        "phrase long, unit long, id long, digest long, start int, n int, windows binary",
    )


def compiled(data: np.ndarray, found: texts.Words, phrases: np.ndarray, rule: Rule):
    """Automaton of the words of the ``phrases`` (sorted hashes), each once; None of no phrases."""
    import ahocorasick

    n = len(found.hashes) - rule.phrase + 1
    if n <= 0 or not len(phrases):
        return None
    hashes = texts.windows(found.hashes, rule.phrase)
    at = np.searchsorted(phrases, hashes)
    at[at == len(phrases)] = 0
    owner = texts.owners(found.offsets)
    known = np.flatnonzero((phrases[at] == hashes) & (owner[:n] == owner[rule.phrase - 1 :]))
    _, first = np.unique(hashes[known], return_index=True)
    raw = _characters(data)
    automaton = ahocorasick.Automaton()
    for i in known[first].tolist():
        words = range(i, i + rule.phrase)
        pattern = " ".join([raw[found.starts[j] : found.ends[j]] for j in words])
        automaton.add_word(f" {pattern} ", int(hashes[i]))
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton


def _characters(data: np.ndarray) -> str:
    """One character per byte, so that places in the text are places in the bytes."""
    return data.tobytes().decode("latin-1")


def located(data: np.ndarray, found: texts.Words, automaton, rule: Rule) -> np.ndarray:
    """The hash of the phrase that the automaton finds to begin at each word, else NO_HIT."""
    begins = np.full(max(0, len(found.hashes) - rule.phrase + 1), NO_HIT)
    if automaton is None:
        return begins
    raw = _characters(data)
    starts, ends = found.starts.tolist(), found.ends.tolist()
    length = found.ends - found.starts + 1
    for a, b in zip(found.offsets[:-1].tolist(), found.offsets[1:].tolist(), strict=True):
        if b - a < rule.window:
            continue
        words = [raw[s:e] for s, e in zip(starts[a:b], ends[a:b], strict=True)]
        # A hit ends at the blank behind its last word, in the text with a blank in front.
        hits = list(automaton.iter(f" {' '.join(words)} "))
        if hits:
            last, phrase = zip(*hits, strict=True)
            place = np.searchsorted(np.cumsum(length[a:b]), last) - rule.phrase + 1
            begins[a + place] = np.array(phrase, np.uint64)
    return begins


def _unit_batch(
    found: texts.Words, hits: np.ndarray, rule: Rule, ids: np.ndarray, digests: np.ndarray
) -> pa.RecordBatch | None:
    chosen = choose(hits, found.offsets, rule)
    start, text, place = chosen.start, chosen.text, chosen.place
    if not len(start):
        return None
    windows = texts.windows(found.hashes, rule.window)[start]
    begin = np.ones(len(start), bool)
    begin[1:] = place[1:] != place[:-1]
    at = np.flatnonzero(begin)
    count = np.diff(np.append(at, len(start)))
    # The phrase's place inside and the windows' hashes name the words of a unit.
    running = np.concatenate([[np.uint64(0)], np.cumsum(texts.mix(windows), dtype=np.uint64)])
    total = running[at + count] - running[at]
    unit = texts.mix(total + texts.seeded((place[at] - start[at]).astype(np.uint64), 5))
    raw = pa.py_buffer(windows.tobytes())
    ends = pa.array(np.append(at, len(start)) * 8, pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hits[place[at]].view(np.int64)),
            pa.array(unit.view(np.int64)),
            pa.array(ids[text[at]]),
            pa.array(digests[text[at]]),
            pa.array((start[at] - found.offsets[text[at]]).astype(np.int32)),
            pa.array(count.astype(np.int32)),
            pa.Array.from_buffers(pa.binary(), len(at), [None, ends.buffers()[1], raw]),
        ],
        ["phrase", "unit", "id", "digest", "start", "n", "windows"],
    )


def _repeats(units: DataFrame) -> DataFrame:
    """(id, digest, start, n): runs of windows that also start earlier."""
    ordered = units.repartition("phrase").sortWithinPartitions(
        "phrase", "unit", "id", "digest", "start"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrase, unit, first = None, None, None
        firsts: list[tuple[tuple, bytes]] = []
        for batch in batches:
            out: list[tuple] = []
            keys = [batch.column(i).to_pylist() for i in range(6)]
            windows = batch.column(6)
            for i, (p, u, d, t, s, n) in enumerate(zip(*keys, strict=True)):
                if p != phrase:
                    out += _first_windows(firsts)
                    phrase, unit, firsts = p, None, []
                if u != unit:
                    # The first of its words: it is compared with the other units' windows.
                    unit, first = u, (d, t, s)
                    firsts.append((first, windows[i].as_py()))
                elif (d, t, s) != first:
                    out.append((d, t, s, n))
            if out:
                yield _runs(out)
        if found := _first_windows(firsts):
            yield _runs(found)

    return ordered.mapInArrow(run, "id long, digest long, start int, n int")


def _runs(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "digest", "start", "n"]
    )


def _first_windows(firsts: list[tuple[tuple, bytes]]) -> list[tuple]:
    """Windows of units of one phrase that are repeats of another unit's window."""
    if len(firsts) == 1 and len(firsts[0][1]) == 8 or not firsts:
        return []
    values = np.frombuffer(b"".join(w for _, w in firsts), np.uint64)
    sizes = np.array([len(w) // 8 for _, w in firsts])
    if len(np.unique(values)) == len(values):
        return []
    ids, digests, starts = (np.array(x) for x in zip(*(k for k, _ in firsts), strict=True))
    unit = np.repeat(np.arange(len(firsts)), sizes)
    place = starts[unit] + np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((place, digests[unit], ids[unit], values))
    new = np.ones(len(order), bool)
    new[1:] = values[order][1:] != values[order][:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    # A row that is there twice does not come before itself.
    late = (
        (ids[unit[first]] != ids[unit[order]])
        | (digests[unit[first]] != digests[unit[order]])
        | (place[first] != place[order])
    )
    return [
        (int(ids[unit[i]]), int(digests[unit[i]]), int(place[i]), 1) for i in order[late].tolist()
    ]


def without_repeats(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words of each row that no repeated window covers.

    A window of words is a repeat if its words also start earlier: in a document of smaller
    doc_id, or further in front in the same. kept has the words that stay, in order. Null ids
    come before all others, null texts are empty. Repeated rows give the same result and are
    no repeats of each other; rows of one id with different texts come in the order of a
    digest. Texts shorter than a window stay whole. An empty table gives no rows; other
    columns are not read.
    """
    rows = keyed(documents)
    first, copies = leads(rows)
    same = Window.partitionBy("phrase")
    several = (F.min("digest").over(same) != F.max("digest").over(same)) | (
        F.max("n").over(same) > 1
    )
    wanted = (
        _phrases(rows, rule)
        .select("digest", "phrase", several.alias("several"))
        .filter("several")
        .groupBy("digest")
        .agg(F.collect_set("phrase").alias("phrases"))
        .join(first, "digest")
    )
    whole = packed(rows)
    runs = _repeats(_units(whole, wanted, rule)).select(
        "id", "digest", "start", (F.col("n") + (rule.window - 1)).alias("size")
    )
    joined = with_runs(whole, runs, copies)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, removed = [], [], []
            found = zip(unpacked(batch.column(1)), batch.column(2), batch.column(3), strict=True)
            for text, copy, runs in found:
                words = text.split()
                total.append(len(words))
                gone = np.zeros(len(words) + 1, np.int64)
                if copy.as_py() and len(words) >= rule.window:
                    gone[0] = 1
                elif runs.is_valid:
                    start, size = (c.to_numpy() for c in runs.values.flatten())
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + size, -1)
                stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0) if len(words) else np.zeros(0, int)
                removed.append(len(words) - len(stay))
                kept.append(b" ".join([words[i] for i in stay.tolist()]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "n_removed", "kept"],
            )

    out = joined.mapInArrow(run, "id long, n_words long, n_removed long, kept string")
    return out.select(doc_id(), "n_words", "n_removed", "kept")
