"""Whole texts of Arrow batches as byte arrays, and hashes of their words, without Python loops.

A word is a run of bytes that are not separators, so never leaves its text. Hashes are 64 bits
and alike on every machine: they depend on the bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_LETTERS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLDED = _LETTERS[_FOLD]
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 2 * CHUNK_BYTES), base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[base] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def seeded(h: np.ndarray, seed: int) -> np.ndarray:
    return mix(h + _U((seed * BASE) % (1 << 64)))


def bytes_of(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string array: text i is data[offsets[i]:offsets[i + 1]], null empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    if len(array) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def chunks(
    array: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, data, offsets) of consecutive whole texts, about ``limit`` bytes."""
    data, offsets = bytes_of(array)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """Words of some texts: text i has words offsets[i] to offsets[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray


def words(
    data: np.ndarray, offsets: np.ndarray, fold: bool = False, separators: np.ndarray = SPACES
) -> Words:
    """Find and hash the words; ``fold`` hashes A-Z as a-z."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_FOLDED if fold else _LETTERS)[data] * powers(BASE, n), out=sums[1:])
    inverse = pow(BASE, -1, 1 << 64)
    h = (sums[ends] - sums[starts]) * powers(inverse, n)[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    return Words(starts, ends, h, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values, by start; the caller drops those that leave a text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(powers(0xC2B2AE3D27D4EB4F, k)):
        out += hashes[j : j + n] * factor
    return mix(out)


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text each item belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def fresh(name: str, columns: list[str]) -> str:
    """A column name near ``name`` that is not among ``columns`` (case aside)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
