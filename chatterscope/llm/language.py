"""Language identification: known words first, shorter and shorter character n-grams after that.

A word the model knows scores by its log frequency in each language. A word it does not know
scores by its longest n-grams that are known: the mean log frequency of the n-grams of that
length, n falling from ``LONGEST`` to 1. A text takes the language of the largest sum.

The fit is bounded: at most about ``sample_docs`` texts, ``vocabulary`` words and ``grams``
n-grams, the most frequent of the sample. The sample is a hash range of the ids, its counts
are summed on the cluster, and only the bounded model reaches the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.llm import texts

LONGEST = 5
UNKNOWN = "und"
SMOOTHING = 0.5
NO_LETTER = np.ones(256, bool)
NO_LETTER[ord("a") : ord("z") + 1] = False
NO_LETTER[ord("A") : ord("Z") + 1] = False
NO_LETTER[128:] = False
# Distinct (lang, word) pairs a task holds before it hands on its counts.
HELD = 200_000


@dataclass
class Model:
    """Log frequencies by language: words by sorted hash, n-grams by length and string."""

    languages: list[str]
    hashes: np.ndarray
    scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray

    def unseen(self, word: str) -> np.ndarray:
        """Scores of a word by its longest known n-grams; zeros if it has none."""
        edged = f" {word} "
        for n in range(LONGEST, 0, -1):
            source = edged if n > 1 else word
            found = [
                i
                for i in map(self.grams.get, (source[j : j + n] for j in range(len(source) - n + 1)))
                if i is not None
            ]
            if found:
                return self.gram_scores[found].mean(0)
        return np.zeros(len(self.languages))


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        low = pc.utf8_lower(batch.column(0).cast(pa.large_string()))
        languages = batch.column(1).to_pylist()
        for row, end, data, offsets in texts.chunks(low):
            found = texts.words(data, offsets, separators=NO_LETTER)
            raw = data.tobytes()
            for i in range(end - row):
                a, b = found.offsets[i], found.offsets[i + 1]
                spans = zip(found.starts[a:b].tolist(), found.ends[a:b].tolist(), strict=True)
                language = languages[row + i]
                counts.update((language, raw[s:e]) for s, e in spans)
            if len(counts) > HELD:
                yield _counted(counts)
                counts = Counter()
    if counts:
        yield _counted(counts)


def _counted(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([k[0] for k in keys], pa.string()),
            "word": pa.array([k[1] for k in keys], pa.binary()),
            "n": pa.array(list(counts.values()), pa.int64()),
        }
    )


def fit(
    labelled: DataFrame,
    sample_docs: int = 20_000,
    vocabulary: int = 100_000,
    grams: int = 100_000,
) -> Model | None:
    """A model from (doc_id, text, lang), null texts and languages left out; None if none is left."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    total = rows.count()
    if not total:
        return None
    share = min(1.0, sample_docs / total)
    # Only so many hash values are let in, so the sample is bounded whatever the table holds.
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    if sample.isEmpty():
        # Few ids, each with many rows: as many rows of smallest hash.
        sample = rows.orderBy(F.xxhash64("doc_id", "text")).limit(sample_docs)
    counts = (
        sample.select("text", "lang")
        .mapInArrow(_word_counts, "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    by_word = counts.groupBy("word").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    kept = by_word.orderBy(F.desc("n"), "word").limit(vocabulary).collect()
    if not kept:
        return None
    return build([(bytes(r["word"]), r["by"]) for r in kept], grams)


def build(counts: list[tuple[bytes, dict[str, int]]], grams: int) -> Model:
    """The model of word counts by language."""
    languages = sorted({lang for _, by in counts for lang in by})
    place = {lang: i for i, lang in enumerate(languages)}
    table = np.zeros((len(counts), len(languages)))
    pieces: dict[str, np.ndarray] = {}
    for row, (word, by) in zip(table, counts, strict=True):
        for lang, n in by.items():
            row[place[lang]] = n
        text = word.decode("utf-8", "ignore")
        edged = f" {text} "
        for n in range(1, LONGEST + 1):
            source = edged if n > 1 else text
            for j in range(len(source) - n + 1):
                gram = source[j : j + n]
                known = pieces.get(gram)
                if known is None:
                    pieces[gram] = row.copy()
                else:
                    known += row
    top = sorted(pieces, key=lambda g: (-pieces[g].sum(), g))[:grams]
    per_gram = np.array([pieces[g] for g in top]).reshape(len(top), len(languages))
    lengths = np.array([len(g) for g in top])
    gram_scores = np.zeros_like(per_gram)
    for n in range(1, LONGEST + 1):
        mine = lengths == n
        if mine.any():
            gram_scores[mine] = _log_shares(per_gram[mine])
    joined = pa.array([w for w, _ in counts], pa.binary())
    data, offsets = texts.bytes_of(joined)
    hashes = texts.words(data, offsets, separators=np.zeros(256, bool)).hashes
    order = np.argsort(hashes)
    return Model(
        languages, hashes[order], _log_shares(table)[order], {g: i for i, g in enumerate(top)}, gram_scores
    )


def _log_shares(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * len(counts)))


def score_texts(model: Model, column: pa.Array, memory: dict[int, np.ndarray]) -> np.ndarray:
    """Sums of the word scores of each text, (texts, languages)."""
    low = pc.utf8_lower(column.cast(pa.large_string()))
    sums = np.zeros((len(low), len(model.languages)))
    for row, end, data, offsets in texts.chunks(low):
        found = texts.words(data, offsets, separators=NO_LETTER)
        if not len(found.hashes):
            continue
        at = np.searchsorted(model.hashes, found.hashes)
        at[at == len(model.hashes)] = 0
        known = model.hashes[at] == found.hashes
        scores = model.scores[at]
        unknown = np.flatnonzero(~known)
        if len(unknown):
            distinct, first, back = np.unique(
                found.hashes[unknown], return_index=True, return_inverse=True
            )
            raw = data.tobytes()
            rows = np.empty((len(distinct), len(model.languages)))
            for i, (h, j) in enumerate(zip(distinct.tolist(), unknown[first].tolist(), strict=True)):
                got = memory.get(h)
                if got is None:
                    word = raw[found.starts[j] : found.ends[j]].decode("utf-8", "ignore")
                    got = model.unseen(word)
                    if len(memory) < HELD:
                        memory[h] = got
                rows[i] = got
            scores[unknown] = rows[back]
        running = np.zeros((len(scores) + 1, scores.shape[1]))
        np.cumsum(scores, axis=0, out=running[1:])
        sums[row:end] = running[found.offsets[1:]] - running[found.offsets[:-1]]
    return sums


LETTER = r"\p{L}"


def predict(
    documents: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, then lang_pred and score (0 to 1) of each row's whole text.

    A text that is null or has no letter is ``und`` with score 0, as is every text without a
    model; a text of letters that the model knows nothing of takes the first language, by
    name, with the score of a guess. Ties go to the first language by name. Where a kept
    column is called lang_pred or score, the result's name has an underscore more.
    """
    results = [texts.fresh(n, list(keep)) for n in ("lang_pred", "score")]
    if model is None:
        return documents.select(
            *keep, F.lit(UNKNOWN).alias(results[0]), F.lit(0.0).alias(results[1])
        )
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns = keep if text in keep else (*keep, text)
    at, n = columns.index(text), len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, memory = shared.value, {}
        names = np.array([*fitted.languages, UNKNOWN], object)
        for batch in batches:
            column = batch.column(at)
            sums = score_texts(fitted, column, memory)
            best = sums.argmax(1) if len(sums) else np.zeros(0, np.int64)
            chance = np.exp(sums - sums.max(1, initial=-np.inf)[:, None])
            score = 1.0 / chance.sum(1)
            letters = pc.match_substring_regex(column.cast(pa.large_string()), LETTER)
            none = ~letters.fill_null(False).to_numpy(zero_copy_only=False)
            best[none], score[none] = len(fitted.languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(names[best], pa.string()), pa.array(score)],
                [*batch.schema.names[:n], *results],
            )

    schema = documents.select(*keep).schema.add(results[0], "string").add(results[1], "double")
    return documents.select(*columns).mapInArrow(run, schema)


def fold_of(column: Column, folds: int) -> Column:
    """crc32 of a value's text, modulo ``folds``; a null value counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds
