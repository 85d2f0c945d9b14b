"""Words of clean texts by Arrow batches: what a task does with a column of texts or words.

``text`` and ``sentiment`` offer these as Columns; calls that follow each other are evaluated in
one pass, so only the last result goes back. Spark's own expressions look at every word
through an interpreted lambda, which costs several times as much.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes of text that are cleaned at a time.
SLICE_BYTES = 4 << 20
# Ends a clean text among others; cleaning leaves no such byte.
MARK = b"\0"
# Up to so many characters are replaced one after the other.
FEW = 16

_URL = re.compile(r"(?:http|www)\S+")
_MENTION = re.compile(r"@\w*")
_ASCII = bytes(range(128))
_SPACES = b"\t\n\v\f\r\x1c\x1d\x1e\x1f "
_KEPT = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_" + _SPACES
_NOISE = bytes(set(_ASCII) - set(_KEPT) - set(MARK))
_LOWER = bytes(32 if c in _SPACES else c + 32 if 65 <= c <= 90 else c for c in range(256))


@lru_cache(maxsize=1 << 16)
def _instead(c: str) -> str:
    """What a character beyond ASCII becomes: nothing where it is neither a letter, a non-decimal
    number, an underscore nor white space; a blank; its lower case."""
    if re.match(r"[^\w\s]|\d", c):
        return ""
    return " " if c.isspace() else c.lower()


_LATIN = [_instead(chr(c)) for c in range(128, 256)]
_LATIN_LOWER = _LOWER[:128] + bytes(ord(new or "\0") for new in _LATIN)
_LATIN_NOISE = _NOISE + bytes(c for c, new in enumerate(_LATIN, 128) if not new)


def _beyond_latin(marked: bytes) -> bytes:
    """Texts whose ASCII is clean, with their other characters clean too."""
    odd = set(marked.translate(None, _ASCII).decode())
    changes = {c: new for c in odd if (new := _instead(c)) != c}
    # The lower case of this letter depends on what stands around it.
    sigma = changes.pop("\u03a3", None)
    if len(changes) > FEW:
        marked = marked.decode().translate(str.maketrans(changes)).encode()
    else:
        # Signs before capitals, as the lower case of a few letters holds a sign.
        for c, new in sorted(changes.items(), key=lambda change: len(change[1])):
            marked = marked.replace(c.encode(), new.encode())
    return marked.decode().lower().encode() if sigma else marked


def _marked(texts: Sequence[bytes | None], ascii_only: bool) -> bytes:
    """Texts without URLs, mentions, signs and digits, in lower case, a MARK behind each; words
    stand between blanks. All at once, so that few calls look at the bytes."""
    # A sign like any other takes the place of a MARK in a text.
    parts = [(text or b"").replace(MARK, b"\1") for text in texts]
    parts = [
        _URL.sub("", part.decode("utf-8", "replace")).encode() if b"http" in part or b"www" in part else part
        for part in parts
    ]
    whole = _MENTION.sub("", MARK.join([*parts, b""]).decode("utf-8", "replace"))
    if ascii_only:
        return whole.encode("ascii", "ignore").translate(_LOWER, _NOISE)
    try:
        return whole.encode("latin-1").translate(_LATIN_LOWER, _LATIN_NOISE).decode("latin-1").encode()
    except UnicodeEncodeError:
        return _beyond_latin(whole.encode().translate(_LOWER, _NOISE))


def _words(marked: bytes) -> pa.ListArray:
    """The words of each marked text."""
    raw = np.frombuffer(marked, np.uint8)
    # No other bytes up to the blank are left.
    gaps = np.flatnonzero(raw <= ord(" "))
    ends = gaps - np.arange(len(gaps))
    is_word = np.diff(ends, prepend=0) > 0
    offsets = np.concatenate([[0], ends[is_word]]).astype(np.int32)
    letters = marked.translate(None, b" " + MARK)
    values = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(letters))
    before = np.cumsum(is_word)[raw[gaps] == ord(MARK)]
    return _listed(np.diff(before, prepend=0), values)


def _listed(counts: np.ndarray, values: pa.Array, nulls: np.ndarray | None = None) -> pa.ListArray:
    """Lists of so many of the values each."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    mask = None if nulls is None or not nulls.any() else pa.array(nulls)
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=mask)


def _parts(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Length of each list, all values, and which lists are null."""
    nulls = lists.is_null().to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return counts.astype(np.int64), lists.flatten(), nulls


def split(column: pa.Array) -> pa.ListArray:
    """The words of clean texts, where one blank separates them."""
    counts, values, nulls = _parts(pc.split_pattern(column.cast(pa.string()), " "))
    return _kept(counts, values, pc.not_equal(values, ""), nulls)


def _kept(counts: np.ndarray, values: pa.Array, wanted: pa.Array, nulls: np.ndarray) -> pa.ListArray:
    chosen = wanted.fill_null(False).to_numpy(zero_copy_only=False)
    if chosen.all():
        return _listed(counts, values, nulls)
    before = np.concatenate([[0], np.cumsum(chosen)])
    ends = np.cumsum(counts)
    return _listed(before[ends] - before[ends - counts], values.filter(pa.array(chosen)), nulls)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of a text column, of about ``limit`` bytes, a row at least."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(column):
        done = ends[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield column.slice(row, end - row)
        row = end


def clean(column: pa.Array, ascii_only: bool = False) -> pa.ListArray:
    """The words of the clean text of each text; a null has none."""
    found = [
        _words(_marked(part.to_pylist(), ascii_only))
        for part in slices(column.cast(pa.binary()))
    ]
    return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.string()))


def without(lists: pa.ListArray, stopwords: Sequence[str]) -> pa.ListArray:
    counts, values, nulls = _parts(lists)
    known = pc.is_in(values, value_set=pa.array(stopwords, pa.string()))
    return _kept(counts, values, pc.and_(pc.invert(known), pc.is_valid(values)), nulls)


def longer(lists: pa.ListArray, least: int, stopwords: Sequence[str]) -> pa.ListArray:
    """The words of ``least`` or more characters, stop words left out."""
    counts, values, nulls = _parts(without(lists, stopwords))
    return _kept(counts, values, pc.greater_equal(pc.utf8_length(values), least), nulls)


def alphabetic(lists: pa.ListArray, stopwords: Sequence[str]) -> pa.ListArray:
    """The words of letters only, stop words left out."""
    counts, values, nulls = _parts(without(lists, stopwords))
    # Asked once for each distinct word.
    coded = values.dictionary_encode()
    letters = [not w or w.isalpha() for w in coded.dictionary.to_pylist()]
    return _kept(counts, values, pa.array(letters, pa.bool_()).take(coded.indices), nulls)


# Words and their entries: a mapping, or a broadcast pair of arrays.
Entries = Mapping | Broadcast


def _pairs(entries: Entries, kind: pa.DataType) -> tuple[pa.Array, pa.Array]:
    if isinstance(entries, Broadcast):
        return entries.value
    return pa.array(entries.keys(), pa.string()), pa.array(entries.values(), kind)


def _places(values: pa.Array, known: pa.Array) -> pa.Array:
    """Where each value stands among the ``known``, null where it does not; a table is built of the
    fewer of both, as a batch has far fewer words than a large dictionary."""
    coded = values.dictionary_encode()
    asked = coded.dictionary
    if len(known) <= len(asked):
        return pc.index_in(asked, value_set=known).take(coded.indices)
    found = pc.index_in(known, value_set=asked)
    there = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    at = np.full(len(asked), -1, np.int32)
    at[found.drop_null().to_numpy()] = there
    return pa.array(at, mask=at < 0).take(coded.indices)


def replaced(lists: pa.ListArray, entries: Entries) -> pa.ListArray:
    """Each word's entry, or the word where it has none."""
    counts, values, nulls = _parts(lists)
    known, instead = _pairs(entries, pa.string())
    return _listed(counts, pc.coalesce(instead.take(_places(values, known)), values), nulls)


def looked_up(lists: pa.ListArray, entries: Broadcast) -> pa.ListArray:
    """(token, value) of each word, the value null where it has no entry."""
    counts, values, nulls = _parts(lists)
    known, entry = entries.value
    found = [values, entry.take(_places(values, known))]
    return _listed(counts, pa.StructArray.from_arrays(found, ["token", "value"]), nulls)


def _hits(lists: pa.ListArray, entries: Entries, negators: Sequence[str]):
    """(counts, values, at, row, entry, negated) of the words that have an entry, in order."""
    counts, values, _ = _parts(lists)
    known, entry = _pairs(entries, pa.float64())
    found = _places(values, known)
    at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    entry = entry.to_numpy()[found.drop_null().to_numpy()]
    ends = np.cumsum(counts)
    row = np.searchsorted(ends, at, side="right")
    inside = at > (ends - counts)[row]
    before = values.take(pa.array(np.maximum(at - 1, 0)))
    turned = pc.is_in(before, value_set=pa.array(negators, pa.string()))
    return counts, values, at, row, entry, inside & turned.to_numpy(zero_copy_only=False)


def polarity(
    lists: pa.ListArray, entries: Entries, negators: Sequence[str], negation: float
) -> pa.Array:
    """Mean entry of the words that have one, 0.0 if none has; ``negation`` times behind a negator."""
    counts, _, _, row, entry, negated = _hits(lists, entries, negators)
    n = np.bincount(row, minlength=len(counts))
    total = np.bincount(row, entry * np.where(negated, negation, 1.0), minlength=len(counts))
    return pa.array(np.divide(total, n, out=np.zeros(len(counts)), where=n > 0))


def _sums(values: pa.Array, **sums: np.ndarray) -> pa.RecordBatch:
    """Each distinct value with the sums of what stands beside it."""
    coded = values.dictionary_encode()
    codes = coded.indices.to_numpy()
    added = [np.bincount(codes, s, len(coded.dictionary)).astype(np.int64) for s in sums.values()]
    return pa.RecordBatch.from_arrays(
        [coded.dictionary, *[pa.array(a) for a in added]], ["word", *sums]
    )


def neighbours(
    lists: pa.ListArray, signs: Mapping[str, int], negators: Sequence[str], window: int
) -> pa.RecordBatch:
    """(word, positive, negative): words within ``window`` words of one that has a sign."""
    counts, values, at, row, sign, negated = _hits(lists, signs, negators)
    ends = np.cumsum(counts)
    sign = np.where(negated, -sign, sign)
    near, signed = [np.zeros(0, np.int64)], [np.zeros(0)]
    for step in [*range(-window, 0), *range(1, window + 1)]:
        there = at + step
        inside = (there >= (ends - counts)[row]) & (there < ends[row]) & (sign != 0)
        near.append(there[inside])
        signed.append(sign[inside])
    side = np.concatenate(signed)
    return _sums(values.take(pa.array(np.concatenate(near))), positive=side > 0, negative=side < 0)


def cells_of(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, code, n, words): how often each word stands in each list."""
    counts, values, _ = _parts(lists)
    coded = values.dictionary_encode()
    many = max(len(coded.dictionary), 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    cell, n = np.unique(owner * many + coded.indices.to_numpy(), return_counts=True)
    return cell // many, cell % many, n, coded.dictionary


def bags(lists: pa.ListArray) -> pa.ListArray:
    """(term, n) of the distinct words of each list."""
    row, code, n, known = cells_of(lists)
    cells = pa.StructArray.from_arrays([known.take(pa.array(code)), pa.array(n, pa.int64())], ["term", "n"])
    return _listed(np.bincount(row, minlength=len(lists)), cells)


def totals(lists: pa.ListArray) -> pa.RecordBatch:
    """(word, n): how often each word stands in the lists."""
    _, values, _ = _parts(lists)
    return _sums(values, n=np.ones(len(values)))


def totals_of(lists: pa.ListArray, wanted: Broadcast) -> pa.RecordBatch:
    """``totals`` of the ``wanted`` words alone."""
    found = totals(lists)
    return found.filter(pc.is_in(found["word"], value_set=wanted.value))


def statistics(lists: pa.ListArray) -> pa.RecordBatch:
    """(word, n, df): how often each word stands in the lists, and in how many of them."""
    _, code, n, known = cells_of(lists)
    return _sums(known.take(pa.array(code)), n=n, df=np.ones(len(code)))


def by_batch(
    words: Callable[[pa.Array], pa.ListArray], count: Callable[[pa.ListArray], pa.RecordBatch]
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: counts of the words of a text column, for each part of a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0), 4 * SLICE_BYTES):
                yield count(words(part))

    return run


def column(function: Callable[..., pa.Array], kind: str, c: Column, *given) -> Column:
    """``function`` as a Column, with the values ``given`` behind the column's batches."""
    # A name of its own, so that the annotation tells Spark what kind of function this is.
    def run(batch: pa.Array) -> pa.Array:
        return function(batch, *given)

    return F.arrow_udf(run, kind)(c)
