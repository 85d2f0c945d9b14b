"""Best-fit packing of documents into training sequences under several capacities.

A document is its byte-level BPE ids and an end id; only one longer than a sequence is cut.
A sequence is a bin with three residual capacities: tokens, documents, and attention cost (the
sum of its pieces' squared lengths). Pieces go in by falling length. Each takes the bin that
fits it in every capacity and is best by a weighted measure of the residual vector: the least
norm of what would be left, or the largest dot product of piece and residual.

Pieces of a length are alike, so the choice is made over a histogram, which has as many rows
as a sequence has tokens, whatever the input. The plan it gives says which ranks of a length go to
which bins; ranks are counted by Spark, in salted groups of bounded size.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatterscope.llm.texts import fresh
from chatterscope.plans.lineage import cut_lineage

END = 2
# Rows of one length that one task ranks.
RANKED_ROWS = 20_000
# How texts are taken apart before merging (fixed value); possessive where nothing can be given back.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most, and how residual vectors are weighed.

    ``documents`` and ``attention`` bind nothing where they are None. ``weights`` are for
    tokens, documents and attention; ``measure`` is ``norm`` or ``dot``.
    """

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    measure: str = "norm"

    def capacity(self) -> np.ndarray:
        """Of tokens, documents and attention; pieces have a token at least."""
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, documents, attention], np.int64)


def letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Bytes that print stand for themselves, the others follow from code point 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of a tokenizers file; its control strings are ordinary text."""
    import tiktoken

    stated = json.loads(Path(path).read_text())
    special = {t["content"] for t in stated["added_tokens"]}
    byte = letters()
    ranks = {
        bytes(byte[c] for c in token): rank
        for token, rank in stated["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("stated", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def cut(length: int, tokens: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: all whole, but for the first."""
    first = length % tokens or tokens
    return [(0, first), *((start, tokens) for start in range(first, length, tokens))]


def pieces(
    documents: DataFrame,
    path: str,
    tokens: int = 1024,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), and ids if asked for, of all documents.

    ``ids_crc32`` is of the ids as little-endian 32-bit numbers. A null text is empty, an
    empty one is the end id alone. A null doc_id stays null; repeated rows and ids give pieces
    each. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                rows, ids = [], []
                part = batch.slice(at, BATCH)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    whole = np.array(array("I", encode(text.as_py() or "") + [END]), "<u4")
                    for number, (start, length) in enumerate(cut(len(whole), tokens)):
                        own = whole[start : start + length]
                        rows.append((doc, number, start, length, zlib.crc32(own.tobytes())))
                        if with_ids:
                            ids.append(own)
                columns = [
                    pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)
                ]
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    flat = np.concatenate(ids).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECE + (", ids array<int>" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# Documents whose pieces go into one output batch.
BATCH = 1024
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())


@dataclass
class Bins:
    """``count`` sequences alike: what is left of each, and (length, how many) in order."""

    left: np.ndarray
    count: int
    holds: tuple[tuple[int, int], ...]

    def taking(self, length: int, n: int, count: int) -> Bins:
        before = self.holds
        if before and before[-1][0] == length:
            before, n_all = before[:-1], before[-1][1] + n
        else:
            n_all = n
        return Bins(self.left - n * vector(length), count, (*before, (length, n_all)))


def vector(length: int) -> np.ndarray:
    """What a piece takes of each capacity."""
    return np.array([length, 1, length**2], np.int64)


def badness(left: np.ndarray, length: int, limits: Limits) -> np.ndarray:
    """Of bins with residuals ``left`` for a piece: the least is best."""
    full, weights = limits.capacity(), np.array(limits.weights)
    if limits.measure == "dot":
        return -((left / full) * (vector(length) / full) @ weights)
    if limits.measure == "norm":
        return ((left - vector(length)) / full) ** 2 @ weights
    raise ValueError(f"no measure {limits.measure}")


def at_once(left: np.ndarray, length: int, limits: Limits, alone: bool = False) -> int:
    """How many pieces a bin takes one after another before an equal bin would be better.

    ``alone``: no other bin takes the piece, so this one is filled.
    """
    n, first = 1, badness(left, length, limits)
    while True:
        now = left - n * vector(length)
        if (now < vector(length)).any() or not alone and badness(now, length, limits) > first:
            return n
        n += 1


def plan(counts: Mapping[int, int], limits: Limits) -> list[Bins]:
    """The bins of all pieces, given the number of pieces of each length.

    A length adds two kinds of bins at most, so there are at most twice as many kinds as a
    sequence has tokens, however many pieces there are. Ties go to the older kind.
    """
    kinds: list[Bins] = []
    for length in sorted((n for n, many in counts.items() if many), reverse=True):
        own = vector(length)
        if length < 1 or (own > limits.capacity()).any():
            raise ValueError(f"no sequence holds {length} tokens")
        waiting = counts[length]
        left = np.array([k.left for k in kinds]).reshape(-1, 3)
        bad = np.where((left >= own).all(1), badness(left, length, limits), np.inf)
        while waiting and len(bad) and np.isfinite(bad.min()):
            i = int(bad.argmin())
            kind, n = kinds[i], at_once(left[i], length, limits)
            full = min(waiting // n, kind.count)
            waiting -= full * n
            if full == kind.count:
                kinds[i] = kind.taking(length, n, full)
                left[i] = kinds[i].left
                fits = (left[i] >= own).all()
                bad[i] = badness(left[i], length, limits) if fits else np.inf
                continue
            # The last pieces of this length: some bins of the kind stay as they are.
            made = [kind.taking(length, n, full)] if full else []
            made += [kind.taking(length, waiting, 1)] if waiting else []
            untouched = kind.count - full - (1 if waiting else 0)
            made += [Bins(kind.left, untouched, kind.holds)] if untouched else []
            kinds[i] = made[0]
            kinds += made[1:]
            waiting = 0
        if waiting:
            empty = Bins(limits.capacity(), 0, ())
            n = at_once(empty.left, length, limits, alone=True)
            kinds += [empty.taking(length, n, waiting // n)] if waiting >= n else []
            kinds += [empty.taking(length, waiting % n, 1)] if waiting % n else []
    return kinds


@dataclass
class Places:
    """Where the pieces go: from rank ``first`` of ``length`` on, ``each`` to a bin from ``bin``."""

    key: np.ndarray
    first: np.ndarray
    each: np.ndarray
    bin: np.ndarray
    offset: np.ndarray

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by their rank from 0 among those of their length."""
        row = np.searchsorted(self.key, (length << RANK_BITS) + rank, side="right") - 1
        place = rank - self.first[row]
        bins, slot = np.divmod(place, self.each[row])
        return self.bin[row] + bins, self.offset[row] + slot * length


# A length and a rank share 64 bits.
RANK_BITS = 44


def places(kinds: list[Bins]) -> Places:
    rows, taken, number = [], {}, 0
    for kind in kinds:
        offset = 0
        for length, each in kind.holds:
            first = taken.get(length, 0)
            rows.append(((length << RANK_BITS) + first, first, each, number, offset))
            taken[length] = first + each * kind.count
            offset += length * each
        number += kind.count
    rows.sort()
    return Places(*np.array(rows, np.int64).reshape(-1, 5).T)


def pack(cut_documents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All columns of ``cut_documents``, and each row's sequence_id and offset there.

    Each row needs a ``length`` from 1 on that an empty sequence can take; offsets of a sequence leave no gap. All
    rows are placed, repeated ones each for itself; which of the rows of one length goes where
    follows from their order in the input. Columns called sequence_id or offset are replaced.
    An empty table gives no rows.
    """
    columns = [c for c in cut_documents.columns if c.lower() not in ("sequence_id", "offset")]
    at, salt, base, rank = (fresh(n, columns) for n in ("_at", "_salt", "_base", "_rank"))
    # Written once: the pieces are counted and ranked from the same rows in the same order.
    rows = cut_lineage(cut_documents.select(*columns)).withColumn(
        at, F.monotonically_increasing_id()
    )
    # A row for each length at most.
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    where = places(plan(counts, limits))
    salts = max(1, -(-max(counts.values(), default=0) // RANKED_ROWS))
    rows = rows.withColumn(salt, (F.col(at) % salts).cast("int"))
    before = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("length", salt).agg(F.count("*").alias(base))
    bases = bases.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    ranked = rows.withColumn(
        rank, F.row_number().over(Window.partitionBy("length", salt).orderBy(at)) - 1
    )
    ranked = ranked.join(bases, ["length", salt]).select(
        *columns, (F.col(base) + F.col(rank)).alias(rank)
    )
    length_at, rank_at = columns.index("length"), len(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(length_at).to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, offset = where.of(length, batch.column(rank_at).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:rank_at], pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    types = {f.name: f.dataType.simpleString() for f in ranked.schema.fields}
    kept = "".join(f"`{c}` {types[c]}, " for c in columns)
    return ranked.mapInArrow(run, f"{kept}sequence_id long, offset long")


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """(sequence_id, ids, starts): the ids of each sequence, and where its pieces start.

    A sequence has as many ids as ``Limits.tokens`` at most, so groups are bounded.
    """
    held = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids")))).alias("held")
    )
    return held.select(
        "sequence_id",
        F.flatten(F.col("held.ids")).alias("ids"),
        F.col("held.offset").alias("starts"),
    )
