"""Repeated byte strings across documents, by the interval tree of enhanced suffix arrays.

Every window of ``least`` bytes chooses its gram, the ``gram`` bytes of least hash in it; equal
windows choose equal grams. Grams that only one text chose cannot be in a repeat:

1. The chosen grams of all texts meet in buckets of bounded size, which tell each text the
   grams it shares with another.
2. A unit is a run of windows that chose one occurrence of a shared gram, with all bytes of
   these windows. Units meet by gram, in order of document; equal units are one.
3. The distinct units of many grams make an enhanced suffix array. A stack scan of the common
   prefix lengths gives its interval tree; intervals of at least ``least`` bytes whose suffixes
   follow different bytes are the maximal repeats, each with all its occurrences. Where a
   repeat occurs in an earlier document, its windows in the later ones are covered.
4. A gram of more than ``UNITS`` distinct units makes no suffix array: its windows are dealt
   by their bytes, so equal ones meet in order of document, whatever the gram's size.

Documents of equal text are one, as all of them but those of the smallest id are repeats.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.llm import texts
from chatterscope.llm.rows import doc_id, keyed, leads, packed, unpacked, with_runs

#: Bytes of text whose chosen grams, about a sixteenth as many, meet in one bucket.
BUCKET_BYTES = 32 << 20
#: Distinct units that make one suffix array; it has at most twice as many. A gram of more is
#: judged window by window.
UNITS = 4096
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    """Strings of ``least`` bytes are judged, by grams of ``gram`` bytes."""

    least: int = 50
    gram: int = 20

    @property
    def widest(self) -> int:
        """Bytes of the longest unit: one window for each place of the gram in it."""
        return 2 * self.least - self.gram


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on."""
    n = len(data) - gram + 1
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(texts._LETTERS[data] * texts.powers(texts.BASE, len(data)), out=sums[1:])
    inverse = pow(texts.BASE, -1, 1 << 64)
    return texts.mix((sums[gram:] - sums[:-gram]) * texts.powers(inverse, n))


def least_places(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each ``width`` consecutive values, and its leftmost place; by doubling."""
    best, place, size = values, np.arange(len(values), dtype=np.int32), 1

    def meet(shift: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(best) - shift
        right = best[shift:] < best[:n]
        return (
            np.where(right, best[shift:], best[:n]),
            np.where(right, place[shift:], place[:n]),
        )

    while size * 2 <= width:
        best, place = meet(size)
        size *= 2
    if size < width:
        best, place = meet(width - size)
    return best, place


@dataclass
class Choice:
    """Windows of some texts, by start: the place and hash of the chosen gram, and the text.

    Hashes have 48 bits, which is what goes through the exchange: grams that collide are
    compared for nothing, no more.
    """

    start: np.ndarray
    place: np.ndarray
    hash: np.ndarray
    text: np.ndarray


def choose(data: np.ndarray, offsets: np.ndarray, rule: Rule) -> Choice:
    none = np.zeros(0, np.int64)
    if len(data) < rule.least:
        return Choice(none, none, np.zeros(0, np.uint64), none)
    hashes, places = least_places(gram_hashes(data, rule.gram), rule.least - rule.gram + 1)
    count = np.maximum(np.diff(offsets) - rule.least + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    start = np.arange(len(text)) + np.repeat(offsets[:-1] - (np.cumsum(count) - count), count)
    return Choice(start, places[start].astype(np.int64), hashes[start] >> _U(16), text)


def _new_runs(chosen: Choice) -> np.ndarray:
    """Where a run of windows with one place begins. A place belongs to one text."""
    begin = np.ones(len(chosen.place), bool)
    begin[1:] = chosen.place[1:] != chosen.place[:-1]
    return np.flatnonzero(begin)


def _bucket_rows(rows: DataFrame, buckets: int, rule: Rule) -> DataFrame:
    """(bucket, digests, texts, grams): chosen grams of a block of texts, once per text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            digests = batch.column(0).to_numpy()
            for row, end, data, offsets in texts.chunks(batch.column(1)):
                chosen = choose(data, offsets, rule)
                new = np.zeros(end - row, bool)
                for i, digest in enumerate(digests[row:end].tolist()):
                    new[i] = digest not in seen
                    seen.add(digest)
                at = _new_runs(chosen)
                at = at[new[chosen.text[at]]] if len(at) else at
                grams, owner = chosen.hash[at], chosen.text[at].astype(np.int32)
                bucket = (texts.mix(grams + _U(1)) % _U(buckets)).astype(np.int64)
                order = np.lexsort((owner, grams, bucket))
                grams, owner, bucket = grams[order], owner[order], bucket[order]
                fresh = np.ones(len(order), bool)
                fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
                grams, owner, bucket = grams[fresh], owner[fresh], bucket[fresh]
                numbers, begin = np.unique(bucket, return_index=True)
                stops = np.append(begin[1:], len(bucket))
                if not len(numbers):
                    continue
                parts = [slice(a, b) for a, b in zip(begin, stops, strict=True)]
                used = [np.unique(owner[p], return_inverse=True) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers.astype(np.int32)),
                        pa.array([digests[row:end][u].tobytes() for u, _ in used], pa.binary()),
                        pa.array([i.astype(np.uint16 if len(u) < 65536 else np.uint32).tobytes() for u, i in used], pa.binary()),
                        pa.array([_short(grams[p]) for p in parts], pa.binary()),
                    ],
                    ["bucket", "digests", "texts", "grams"],
                )

    return rows.select("digest", "text").mapInArrow(
        run, "bucket int, digests binary, texts binary, grams binary"
    )


def _short(hashes: np.ndarray) -> bytes:
    """48-bit values, six bytes each."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(raw: bytes) -> np.ndarray:
    cells = np.zeros((len(raw) // 6, 8), np.uint8)
    cells[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return cells.reshape(-1).view("<u8")


SHARED = "part int, digests binary, counts binary, grams binary"


def _shared(table: pa.Table, parts: int) -> pa.Table:
    """The grams of one bucket that several texts have, by part of the texts: which texts, how
    many grams of each, and these grams."""
    digests, grams = [], []
    columns = (table.column(c).to_pylist() for c in ("digests", "texts", "grams"))
    for d, t, g in zip(*columns, strict=True):
        values, known = _long(g), np.frombuffer(d, np.int64)
        kind = np.uint16 if len(t) == 2 * len(values) else np.uint32
        grams.append(values)
        digests.append(known[np.frombuffer(t, kind)])
    gram, digest = np.concatenate(grams), np.concatenate(digests)
    order = np.argsort(gram, kind="stable")
    gram, digest = gram[order], digest[order]
    begin = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
    several = np.minimum.reduceat(digest, begin) != np.maximum.reduceat(digest, begin)
    mine = np.repeat(several, np.diff(np.append(begin, len(gram))))
    gram, digest = gram[mine], digest[mine]
    part = (texts.mix(digest.view(np.uint64)) % _U(parts)).astype(np.int32)
    order = np.lexsort((digest, part))
    gram, digest, part = gram[order], digest[order], part[order]
    rows: dict[str, list] = {"part": [], "digests": [], "counts": [], "grams": []}
    edges = np.searchsorted(part, np.arange(parts + 1))
    for number in np.unique(part).tolist():
        some = slice(edges[number], edges[number + 1])
        first = np.flatnonzero(np.append(True, digest[some][1:] != digest[some][:-1]))
        counts = np.diff(np.append(first, len(digest[some])))
        rows["part"].append(number)
        rows["digests"].append(digest[some][first].tobytes())
        rows["counts"].append(counts.astype(np.uint32).tobytes())
        rows["grams"].append(_short(gram[some]))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds, strict=True)})


def _by_text(table: pa.Table) -> pa.Table:
    """(digest, grams): all shared grams of each text of one part."""
    digests, grams = [], []
    columns = (table.column(c).to_pylist() for c in ("digests", "counts", "grams"))
    for d, n, g in zip(*columns, strict=True):
        digests.append(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(n, np.uint32)))
        grams.append(_long(g))
    gram, digest = np.concatenate(grams), np.concatenate(digests)
    order = np.argsort(digest, kind="stable")
    gram, digest = gram[order], digest[order]
    first = np.flatnonzero(np.append(True, digest[1:] != digest[:-1]))
    ends = np.append(first, len(digest)).tolist()
    return pa.table(
        {
            "digest": pa.array(digest[first], pa.int64()),
            "grams": pa.array(
                [_short(gram[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()
            ),
        }
    )


UNIT = "gram long, id long, digest long, start int, bytes binary"


def _units(whole: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """Units of all occurrences of shared grams."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(3)
            column = pa.array(unpacked(batch.column(2)), pa.large_binary())
            for row, end, data, offsets in texts.chunks(column):
                chosen = choose(data, offsets, rule)
                at = _new_runs(chosen)
                if not len(at):
                    continue
                count = np.diff(np.append(at, len(chosen.start)))
                raw = b"".join(lists[i].as_py() for i in range(row, end))
                shared = np.unique(_long(raw))
                near = np.searchsorted(shared, chosen.hash[at])
                near[near == len(shared)] = 0
                mine = shared[near] == chosen.hash[at]
                at, count = at[mine], count[mine]
                if not len(at):
                    continue
                first, last = chosen.start[at], chosen.start[at] + count + rule.least - 1
                size = last - first
                where = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
                joined = data[where]
                text = chosen.text[at]
                ends = np.append(0, np.cumsum(size))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chosen.hash[at].view(np.int64)),
                        pa.array(ids[row:end][text]),
                        pa.array(digests[row:end][text]),
                        pa.array((first - offsets[text]).astype(np.int32)),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(at),
                            [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(joined.tobytes())],
                        ),
                    ],
                    ["gram", "id", "digest", "start", "bytes"],
                )

    joined = whole.join(wanted, ["id", "digest"]).select("id", "digest", "packed", "grams")
    return joined.mapInArrow(run, UNIT)


@dataclass
class Repeat:
    """A maximal repeat: its length, and (string, offset) of all its occurrences."""

    length: int
    strings: np.ndarray
    offsets: np.ndarray


class SuffixArray:
    """Suffixes of at least ``least`` bytes of some short strings, in order, with the lengths of
    the prefixes that neighbours have in common and the bytes in front of them."""

    def __init__(self, strings: list[bytes], least: int):
        sizes = np.array([len(s) for s in strings])
        width = (int(sizes.max()) + 15) // 8 * 8
        cells = np.zeros((len(strings), width + 8), np.uint8)
        inside = np.arange(width + 8) < sizes[:, None]
        cells[inside] = np.frombuffer(b"".join(strings), np.uint8)
        # Eight bytes from each place on as one number, first byte highest.
        words = np.zeros((len(strings), width + 1), np.uint64)
        for i in range(8):
            words |= cells[:, i : width + 1 + i].astype(np.uint64) << _U(56 - 8 * i)
        count = np.maximum(sizes - least + 1, 0)
        self.string = np.repeat(np.arange(len(strings)), count)
        self.offset = np.arange(len(self.string)) - np.repeat(np.cumsum(count) - count, count)
        left = sizes[self.string] - self.offset
        steps = (width + 7) // 8
        keys = np.zeros((steps, len(self.string)), np.uint64)
        for step in range(steps):
            at = self.offset + 8 * step
            keys[step] = np.where(at <= width, words[self.string, np.minimum(at, width)], _U(0))
        order = np.lexsort((left, *keys[::-1]))
        self.string, self.offset, left = self.string[order], self.offset[order], left[order]
        keys = keys[:, order]
        # Common prefix with the suffix before; 0 for the first.
        common = np.zeros(len(order), np.int64)
        open_ = np.ones(max(len(order) - 1, 0), bool)
        for key in keys:
            differ = key[1:] ^ key[:-1]
            bits = np.zeros(len(differ), np.int64)
            some = open_ & (differ != 0)
            value = differ[some]
            zero = np.zeros(len(value), np.int64)
            for shift in (32, 16, 8):
                small = value >> _U(64 - shift) == 0
                zero[small] += shift // 8
                value = np.where(small, value << _U(shift), value)
            bits[some] = zero
            common[1:] += np.where(open_, np.where(differ != 0, bits, 8), 0)
            open_ &= differ == 0
        common[1:] = np.minimum(common[1:], np.minimum(left[1:], left[:-1]))
        self.common = common
        # The byte in front; in front of a string stands one of its own.
        inner = self.offset > 0
        before = cells[self.string, np.maximum(self.offset - 1, 0)].astype(np.int64)
        self.before = np.where(inner, before, 256 + self.string)

    def repeats(self, least: int) -> Iterator[Repeat]:
        """The maximal repeats of at least ``least`` bytes, from the common prefix intervals."""
        if len(self.common) < 2:
            return
        far = np.flatnonzero(self.common < least)
        stops = np.append(far[1:], len(self.common))
        # A run whose suffixes all follow the same byte has no interval of different ones.
        low = np.minimum.reduceat(self.before, far)
        high = np.maximum.reduceat(self.before, far)
        for begin, stop in zip(far[low != high].tolist(), stops[low != high].tolist(), strict=True):
            yield from self._scan(begin, stop)

    def _scan(self, begin: int, stop: int) -> Iterator[Repeat]:
        """Stack scan of one run: (prefix length, first suffix, byte in front or -1 for several)."""
        common, before = self.common[begin:stop].tolist(), self.before[begin:stop].tolist()
        stack: list[list[int]] = []
        for i in range(1, stop - begin + 1):
            length = common[i] if i < len(common) else 0
            first, front = i - 1, before[i - 1]
            while stack and stack[-1][0] > length:
                depth, start, mixed = stack.pop()
                mixed = mixed if mixed == front else -1
                if mixed == -1:
                    part = slice(begin + start, begin + i)
                    yield Repeat(depth, self.string[part], self.offset[part])
                first, front = start, mixed
            if length:
                if stack and stack[-1][0] == length:
                    if stack[-1][2] != front:
                        stack[-1][2] = -1
                else:
                    stack.append([length, first, front])


def maximal_repeats(strings: list[bytes], least: int) -> list[Repeat]:
    """All maximal repeats of at least ``least`` bytes in and between the strings: what occurs
    several times and is longer in neither direction at all of its occurrences."""
    if not strings:
        return []
    return list(SuffixArray(strings, least).repeats(least))


@dataclass
class _Batch:
    """Distinct units with their smallest id and their occurrences in documents of that id."""

    rule: Rule
    strings: list[bytes] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    places: list[list[tuple[int, int]]] = field(default_factory=list)

    def covered(self) -> list[tuple[int, int, int, int]]:
        """(id, digest, start, size): what is covered by strings of earlier documents."""
        least = self.rule.least
        first = np.array(self.ids)
        gone = np.zeros((len(self.strings), self.rule.widest - least + 2), np.int32)
        for repeat in SuffixArray(self.strings, least).repeats(least):
            ids = first[repeat.strings]
            late = ids > ids.min()
            if late.any():
                strings, offsets = repeat.strings[late], repeat.offsets[late]
                np.add.at(gone, (strings, offsets), 1)
                np.add.at(gone, (strings, offsets + repeat.length - least + 1), -1)
        gone = np.cumsum(gone, axis=1) > 0
        out = []
        for i in np.flatnonzero(gone.any(1)).tolist():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[i].astype(np.int8), [0]])))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                out += [(first[i], d, s + a, b - a + least - 1) for d, s in self.places[i]]
        return out


RUN = "id long, digest long, start int, size int"
#: Runs that are covered, and windows (their bytes with them) that are still to be judged.
FOUND = f"{RUN}, window binary"


def _repeats(units: DataFrame, rule: Rule) -> DataFrame:
    """(id, digest, start, size): runs of bytes covered by strings of earlier documents."""
    ordered = units.repartition("gram").sortWithinPartitions(
        "gram", "bytes", "id", "digest", "start"
    )
    least = rule.least

    def windows(unit: bytes, least_id: int, digest: int, start: int) -> list[tuple]:
        places = range(len(unit) - least + 1)
        return [(least_id, digest, start + i, least, unit[i : i + least]) for i in places]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, unit, least_id, alone, count, hot = None, None, None, True, 0, False
        batch_ = _Batch(rule)
        for batch in batches:
            out: list[tuple] = []
            keys = (batch.column(i).to_pylist() for i in (0, 4, 1, 2, 3))
            for g, u, d, t, s in zip(*keys, strict=True):
                if g != gram:
                    if alone and gram is not None and len(batch_.strings):
                        # The only unit of its gram has no other to be compared with.
                        batch_.strings.pop(), batch_.ids.pop(), batch_.places.pop()
                    if len(batch_.strings) >= UNITS:
                        out += batch_.covered()
                        batch_ = _Batch(rule)
                    gram, unit, alone, count, hot = g, None, True, 0, False
                if u != unit:
                    alone = unit is None
                    unit, least_id = u, d
                    count += 1
                    if count > UNITS and not hot:
                        hot = True
                        for _ in range(count - 1):
                            string, first = batch_.strings.pop(), batch_.ids.pop()
                            for digest, start in batch_.places.pop():
                                out += windows(string, first, digest, start)
                    if not hot:
                        batch_.strings.append(u)
                        batch_.ids.append(d)
                        batch_.places.append([(t, s)])
                elif d != least_id:
                    out.append((d, t, s, len(u)))
                elif not hot:
                    batch_.places[-1].append((t, s))
                if hot and d == least_id:
                    out += windows(u, d, t, s)
            if out:
                yield _found(out)
        if batch_.strings and (found := batch_.covered()):
            yield _found(found)

    found = ordered.mapInArrow(run, FOUND)
    # Runs pass through the exchange of the windows, so the units are worked off once.
    key = F.when(F.col("window").isNull(), F.xxhash64("id", "digest", "start"))
    dealt = found.repartition(key.otherwise(F.xxhash64("window")))
    return dealt.sortWithinPartitions("window", "id").mapInArrow(_judged, RUN)


def _judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs, and the windows that an earlier document has too; equal ones come by id."""
    window, first = None, None
    for batch in batches:
        late = batch.column(4).is_null().to_numpy(zero_copy_only=False).copy()
        ids = batch.column(0)
        for i in np.flatnonzero(~late).tolist():
            w, d = batch.column(4)[i].as_py(), ids[i].as_py()
            if w != window:
                window, first = w, d
            late[i] = d > first
        yield batch.select([0, 1, 2, 3]).filter(pa.array(late))


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    columns = zip(*[r if len(r) == 5 else (*r, None) for r in rows], strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
        ["id", "digest", "start", "size", "window"],
    )


def without_repeats(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each row's bytes outside repeated strings.

    A byte goes if a string of ``least`` bytes that covers it also starts in a document of
    smaller doc_id. kept has the other bytes, in order, n_spans counts the maximal runs that
    went. Texts are taken as UTF-8, null ones as empty; null ids come before all others. Rows
    of one id, repeated or not, are not earlier than each other. Texts shorter than
    ``least`` stay whole. An empty table gives no rows; other columns are not read.
    """
    rows = keyed(documents)
    first, copies = leads(rows)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    wanted = (
        _bucket_rows(rows, buckets, rule)
        .groupBy("bucket")
        .applyInArrow(lambda table: _shared(table, buckets), SHARED)
        .groupBy("part")
        .applyInArrow(_by_text, "digest long, grams binary")
        .join(first, "digest")
    )
    whole = packed(rows)
    joined = with_runs(whole, _repeats(_units(whole, wanted, rule), rule), copies)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for i, text in enumerate(unpacked(batch.column(1))):
                data = np.frombuffer(text, np.uint8)
                gone = np.zeros(len(data) + 1, np.int32)
                runs = batch.column(3)[i]
                if batch.column(2)[i].as_py() and len(data) >= rule.least:
                    gone[0] = 1
                elif runs.is_valid:
                    start, size = (c.to_numpy() for c in runs.values.flatten())
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + size, -1)
                out = np.cumsum(gone)[:-1] > 0
                sizes.append(len(data))
                removed.append(int(out.sum()))
                spans.append(int(np.count_nonzero(np.diff(np.append(0, out.astype(np.int8))) == 1)))
                kept.append(data[~out].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)],
                    pa.array(kept, pa.binary()),
                ],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    out = joined.mapInArrow(
        run, "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return out.select(doc_id(), "n_bytes", "n_removed", "n_spans", "kept")
