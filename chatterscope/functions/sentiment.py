"""Lexicon polarity and its label."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.functions import words
from chatterscope.functions.binding import let
from chatterscope.schema import NEGATORS

THRESHOLD = 0.1
NEGATION = -0.5


def polarity(
    items: Column, entries: words.Entries, negators: Sequence[str] = NEGATORS
) -> Column:
    """Mean polarity of the words ``items`` that have an entry, 0.0 if none has.

    A negator right before a word turns its polarity around and halves it.
    """
    return words.column(words.polarity, "double", items, entries, list(negators), NEGATION)


def negated(items: Column, negators: Sequence[str] = NEGATORS) -> Column:
    """Each word with whether a negator stands right before it."""
    before = F.concat(F.array(F.lit("")), items)
    return F.transform(
        items,
        lambda w, i: F.struct(
            w.alias("token"), F.get(before, i).isin(list(negators)).alias("negated")
        ),
    )


def _label(score: Column) -> Column:
    return (
        F.when(score > THRESHOLD, "Positive")
        .when(score < -THRESHOLD, "Negative")
        .otherwise("Neutral")
    )


def label(score: Column) -> Column:
    return let(score, _label)


def score_text(
    df: DataFrame,
    scorer: Callable[[pd.Series], pd.Series],
    text: str = "text",
    output: str = "score",
) -> DataFrame:
    """Add the score a user-supplied batch function gives each text.

    The function gets the texts of an Arrow batch in parts of bounded size, so a worker holds
    Python strings of one part alone, however long the texts are.
    """

    def score(texts: pa.Array) -> pa.Array:
        parts = [scorer(part.to_pandas()) for part in words.slices(texts)]
        return pa.array(pd.concat(parts), pa.float64()) if parts else pa.array([], pa.float64())

    return df.withColumn(output, words.column(score, "double", F.col(text)))
