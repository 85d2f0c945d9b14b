"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text is a bag of terms: runs of three character classes, words by hash, and what its words
look like as a whole (how many, how varied, how long). The bag is weighted (log count, inverse
document frequency), made unit length and projected on the leading singular vectors of a
bounded labelled sample. The sample's vectors are broadcast (``sample_docs`` times ``rank``
doubles at most); each document meets all of them in blocked products, which give the exact
cosines, and its ``neighbours`` nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.llm import texts

CLASS_TERMS = 1024
WORD_TERMS = 512
STYLE_BUCKETS = 24
STYLES = 6
TERMS = CLASS_TERMS + WORD_TERMS + STYLES * STYLE_BUCKETS
STYLE_WEIGHT = 3.0


def _classes() -> np.ndarray:
    """Lower, upper, digit, blank, line break, each sign of its own, and two of other bytes."""
    kind = np.full(256, 39, np.uint32)
    kind[ord("a") : ord("z") + 1] = 0
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[32], kind[10], kind[13], kind[9] = 3, 4, 4, 3
    signs = [c for c in range(33, 127) if not chr(c).isalnum()]
    kind[signs] = np.arange(5, 5 + len(signs))
    kind[128:192], kind[192:] = 37, 38
    return kind


CLASSES = _classes()


def term_counts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, counts) of blocks of whole texts; counts is (texts, TERMS)."""
    for row, end, data, offsets in texts.chunks(column):
        n = end - row
        counts = np.zeros((n, TERMS), np.float32)
        if len(data) > 2:
            kinds = CLASSES[data]
            triple = (kinds[:-2] * np.uint32(1600) + kinds[1:-1] * np.uint32(40) + kinds[2:])
            term = (triple * np.uint32(2654435761)) >> np.uint32(22)
            owner = texts.owners(offsets)
            whole = owner[:-2] == owner[2:]
            at = owner[:-2][whole] * CLASS_TERMS + term[whole]
            counts[:, :CLASS_TERMS] = np.bincount(at, minlength=n * CLASS_TERMS).reshape(n, -1)
        found = texts.words(data, offsets, fold=True)
        owner = texts.owners(found.offsets)
        word = (found.hashes >> np.uint64(55)).astype(np.int64)
        at = owner * WORD_TERMS + word
        counts[:, CLASS_TERMS : CLASS_TERMS + WORD_TERMS] = np.bincount(
            at, minlength=n * WORD_TERMS
        ).reshape(n, -1)
        _styles(counts[:, CLASS_TERMS + WORD_TERMS :], data, offsets, found, owner)
        yield row, end, counts


def _styles(
    out: np.ndarray, data: np.ndarray, offsets: np.ndarray, found: texts.Words, owner: np.ndarray
) -> None:
    """Soft one-hot buckets of figures of the whole text."""
    n = len(out)
    many = np.diff(found.offsets)
    order = np.lexsort((found.hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (found.hashes[order][1:] != found.hashes[order][:-1]) | (
        owner[order][1:] != owner[order][:-1]
    )
    distinct = np.bincount(owner[order][new], minlength=n)
    run = np.diff(np.append(np.flatnonzero(new), len(new)))
    most = np.zeros(n)
    np.maximum.at(most, owner[order][new], run)
    size = np.maximum(np.diff(offsets), 1)
    some = np.maximum(many, 1)

    def share(chosen: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(chosen)])
        return (running[offsets[1:]] - running[offsets[:-1]]) / size

    kinds = CLASSES[data]
    figures = [
        np.log2(many + 1) / 20,
        distinct / some,
        most / some,
        np.minimum(np.diff(offsets) / some / 24, 1),
        share(kinds == 1),
        share((kinds >= 5) & (kinds < 37)),
    ]
    for i, figure in enumerate(figures):
        at = np.minimum(figure, 1) * (STYLE_BUCKETS - 2)
        low = np.floor(at).astype(np.int64)
        part = out[:, i * STYLE_BUCKETS : (i + 1) * STYLE_BUCKETS]
        part[np.arange(n), low] = 1 - (at - low)
        part[np.arange(n), low + 1] += at - low


@dataclass
class Model:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.idf).astype(np.float64) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled texts."""
        # Rounded, as a product's last digits depend on the block it is computed in.
        near = np.round(self.latent(counts) @ self.vectors.T, 9)
        k = min(self.neighbours, near.shape[1])
        chosen = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(near, chosen, 1), 1e-6, None) ** self.power
        return np.round((weight * self.labels[chosen]).sum(1) / weight.sum(1), 9)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts)
    x[:, : CLASS_TERMS + WORD_TERMS] *= idf[: CLASS_TERMS + WORD_TERMS]
    words = slice(CLASS_TERMS, CLASS_TERMS + WORD_TERMS)
    x[:, :CLASS_TERMS] = _unit(x[:, :CLASS_TERMS])
    x[:, words] = 0.3 * _unit(x[:, words])
    styles = x[:, CLASS_TERMS + WORD_TERMS :]
    styles *= STYLE_WEIGHT / (STYLES * 0.69)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _packed_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column(1)
        for row, end, counts in term_counts(batch.column(0)):
            packed = [c.astype(np.float32).tobytes() for c in counts]
            yield pa.RecordBatch.from_arrays(
                [labels.slice(row, end - row), pa.array(packed, pa.binary())], ["label", "counts"]
            )


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_docs: int = 4000,
    rank: int = 64,
    neighbours: int = 15,
    power: float = 4.0,
) -> Model | None:
    """A model of documents (doc_id, text) and labels (doc_id, label 0 or 1).

    Null labels and ids are not learned from, a document with several labels takes the
    smallest, a null text is empty. The sample holds the ``sample_docs`` labelled ids of
    smallest hash. None where there is nothing to learn.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
    )
    texts_of = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # A repeated document is one example.
    rows = (
        texts_of.select("text", "label", "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .select("text", "label")
        .mapInArrow(_packed_counts, "label int, counts binary")
        .collect()
    )
    if not rows:
        return None
    counts = np.frombuffer(b"".join(bytes(r["counts"]) for r in rows), np.float32)
    counts = counts.reshape(len(rows), TERMS)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 0.1
    x = _weighted(counts, idf)
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    projection = vectors[:, ::-1][:, : min(rank, len(counts))].copy()
    return Model(
        idf,
        projection,
        _unit(x.astype(np.float64) @ projection),
        np.array([r["label"] for r in rows], np.float64),
        neighbours,
        power,
    )


def score(
    documents: DataFrame,
    model: Model | None,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    name: str = "score",
) -> DataFrame:
    """The columns ``keep``, then ``name``: a score (0 to 1, higher: label 1 likelier) of each
    whole text.

    Every row gets a score: a null or empty text that of texts without words, and where
    there is no model each text 0.5. Repeated rows score alike; an empty table gives none.
    Where a kept column has the result's name, that has an underscore more.
    """
    name = texts.fresh(name, list(keep))
    if model is None:
        return documents.select(*keep, F.lit(0.5).alias(name))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns = keep if text in keep else (*keep, text)
    at, n = columns.index(text), len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            # A chunk at a time, as Spark holds a whole batch of what it is given.
            for row, end, counts in term_counts(batch.column(at)):
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(row, end - row) for c in batch.columns[:n]],
                        pa.array(fitted.score(counts)),
                    ],
                    [*batch.schema.names[:n], name],
                )

    schema = documents.select(*keep).schema.add(name, "double")
    return documents.select(*columns).mapInArrow(run, schema)
