"""Dictionaries learned from the feed itself: polarity of words near seeds, lemmas of known words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.functions import words
from chatterscope.functions.dictionary import inline_lookup
from chatterscope.operators.trends import counted_words
from chatterscope.plans.features import words_of
from chatterscope.plans.joins import values_of
from chatterscope.plans.lineage import cut_lineage

WINDOW = 5
LEAST_SUPPORT = 10
SHORTEST_STEM = 2


def seed_neighbours(
    posts: DataFrame,
    seeds: DataFrame,
    window: int = WINDOW,
    negators: Sequence[str] = schema.NEGATORS,
) -> DataFrame:
    """(word, positive, negative): how often each word is within ``window`` words of a seed.

    Only seeds open a window, so rows are bounded by seeds times window, not by pairs of words.
    A seed right behind a negator counts for the other side.
    """
    signs = _signs(seeds).firsts()
    column, split = words_of(posts)
    near = partial(words.neighbours, signs=signs, negators=list(negators), window=window)
    return counted_words(column, split, near, "positive", "negative")


def _signs(seeds: DataFrame):
    sign = F.signum("polarity").cast("int").alias("sign")
    find = inline_lookup(seeds.select("word", sign), "word")
    if find is None:
        raise ValueError("more seed words than fit into a row-local lookup")
    return find


def learn_lexicon(
    posts: DataFrame,
    seeds: DataFrame | None = None,
    window: int = WINDOW,
    least: int = LEAST_SUPPORT,
    stopwords: Sequence[str] | None = None,
    negators: Sequence[str] = schema.NEGATORS,
) -> DataFrame:
    """(word, polarity, support): seeds as stated, and the words that keep their company.

    With p and q the smoothed shares of a word among the neighbours of positive and of negative
    seeds, polarity is (p - q) / (p + q): the hyperbolic tangent of half the difference of
    its two pointwise mutual informations, so between -1 and 1. A word needs ``least``
    neighbourhoods (its support) and letters only; stop words are left out. Seeds have no
    support, of a repeated seed the smallest polarity counts, seeds of polarity 0 open no window.
    Posts without text add nothing. The result is a lexicon for ``with_sentiment``.
    """
    seeds = schema.lexicon(posts.sparkSession) if seeds is None else seeds
    stopwords = schema.stopwords() if stopwords is None else stopwords
    counts = cut_lineage(seed_neighbours(posts, seeds, window, negators))
    totals = counts.agg(
        F.coalesce(F.sum("positive"), F.lit(0)).alias("positive"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("negative"),
    ).first()
    p = (F.col("positive") + 0.5) * (totals["negative"] + 1.0)
    q = (F.col("negative") + 0.5) * (totals["positive"] + 1.0)
    support = F.col("positive") + F.col("negative")
    learned = counts.filter(
        (support >= least)
        & ~F.col("word").isin(list(stopwords))
        & ~F.col("word").rlike(r"[^\p{L}]")
        & _signs(seeds)(F.col("word")).isNull()
    ).select("word", ((p - q) / (p + q)).alias("polarity"), support.alias("support"))
    stated = values_of(seeds, "word", "polarity").select(
        F.col("token").alias("word"),
        F.col("value").cast("double").alias("polarity"),
        F.lit(None).cast("long").alias("support"),
    )
    return learned.unionAll(stated)


def vocabulary(
    posts: DataFrame, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """(word, n): the words of letters of all posts, stop words left out."""
    stopwords = schema.stopwords() if stopwords is None else stopwords
    column, split = words_of(posts)

    def of_letters(texts: pa.Array) -> pa.ListArray:
        return words.alphabetic(split(texts), list(stopwords))

    return counted_words(column, of_letters, words.totals, "n")


def learn_lemmas(
    words: DataFrame,
    exceptions: DataFrame | None = None,
    endings: Sequence[tuple[str, str]] = schema.NOUN_ENDINGS,
    least: int = 1,
) -> DataFrame:
    """(form, lemma, n): lemmas of the forms in the vocabulary ``words`` (word, n).

    A form takes the first of the ``endings`` (ending, what replaces it) that leaves a word the
    vocabulary has at least ``least`` times; what is left of the form has two letters at
    least, and the ending "s" is not taken from "ss". ``exceptions`` (form, lemma) go first
    and need no known lemma. Forms without a lemma are left out; null words are no forms.
    Usable as the lemmas of ``with_tokens`` at any size. The vocabulary is kept, as forms and
    known words both come from it: the texts behind it are read once.
    """
    spark, words = words.sparkSession, cut_lineage(words)
    if exceptions is None:
        exceptions = spark.createDataFrame(schema.LEMMA_EXCEPTIONS, "form string, lemma string")
    forms = words.select(F.col("word").alias("form"), "n")

    def candidate(rank: int, ending: str, put: str) -> Column:
        form = F.col("form")
        stem = F.substring(form, F.lit(1), F.length(form) - len(ending))
        fits = form.endswith(ending) & (F.length(form) >= SHORTEST_STEM + len(ending))
        if ending == "s":
            fits = fits & ~form.endswith("ss")
        value = F.struct(F.lit(rank).alias("rank"), F.concat(stem, F.lit(put)).alias("lemma"))
        return F.when(fits, value)

    candidates = F.filter(
        F.array(*[candidate(i, *rule) for i, rule in enumerate(endings)]),
        lambda c: c.isNotNull(),
    )
    known = words.filter(F.col("n") >= least).select(F.col("word").alias("lemma"))
    by_rule = (
        forms.select("form", "n", F.inline(candidates))
        .join(known, "lemma", "left_semi")
        .groupBy("form")
        .agg(F.min_by("lemma", "rank").alias("lemma"), F.first("n").alias("n"))
    )
    stated = values_of(exceptions, "form", "lemma").withColumnsRenamed(
        {"token": "form", "value": "stated"}
    )
    ruled = by_rule.join(stated, "form", "left_anti").select("form", "lemma", "n")
    return ruled.unionAll(
        forms.join(stated, "form").select("form", F.col("stated").alias("lemma"), "n")
    )
