"""Most frequent words by mergeable summaries, then an exact count of the candidates alone.

A frequent-items summary per task keeps a bounded number of words; merged, it misses no word
that is more frequent than its error. The candidates are counted exactly in a second pass, and
their counts prove that none was missed, or the summary is made larger. The vocabulary itself
is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.functions import text, words
from chatterscope.operators.ranking import explode_names, top
from chatterscope.operators.trends import counted_words
from chatterscope.plans.lineage import cut_lineage

# Characters of the words that are counted, at least.
SHORTEST = 2
# Words that a summary keeps to begin with, and at most.
TRACKED = 1 << 14
MOST_TRACKED = 1_000_000
# A summary that keeps m words has 4/3 m places or more, and an error of 3.5 / places at most.
ERROR = 3.5 * 3 / 4


def clean_words(posts: DataFrame, stopwords: Sequence[str]) -> DataFrame:
    """The words of two or more characters in the clean texts, a row each."""
    kept = words.column(
        words.longer, text.WORDS, text.clean_words(F.col("text")), SHORTEST, list(stopwords)
    )
    return explode_names(posts, kept, "word")


def counts_of(posts: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """(word, n): how often the candidates stand in the clean texts, added up by the tasks first."""
    wanted = posts.sparkSession.sparkContext.broadcast(pa.array(candidates, pa.string()))
    return counted_words(
        posts.select("text"), words.clean, partial(words.totals_of, wanted=wanted), "n"
    )


def summarised(words: DataFrame, tracked: int) -> tuple[list[str], int]:
    """(candidates, words in all) of a summary that keeps ``tracked`` words."""
    summary = words.agg(
        F.count("*").alias("total"),
        F.expr(f"approx_top_k(word, {tracked}, {tracked})").alias("found"),
    ).first()
    return [f["item"] for f in summary["found"] or []], summary["total"]


def word_frequencies_heavy(
    posts: DataFrame, k: int = 200, stopwords: Sequence[str] | None = None, tracked: int = TRACKED
) -> DataFrame:
    """(word, n): the same rows as ``trends.word_frequencies``.

    A word that is no candidate occurs at most ``ERROR / tracked`` times the number of all words.
    Nothing is missed if the k-th candidate is above that, or if the candidates' counts add up to
    all words; else the summary is doubled, and at its largest the plain count is taken.
    """
    stopwords = schema.stopwords() if stopwords is None else stopwords
    heard = clean_words(posts, stopwords)
    while True:
        candidates, total = summarised(heard, tracked)
        # At most ``tracked`` rows from each batch.
        counted = cut_lineage(counts_of(posts, candidates))
        sure = int(ERROR / tracked * total)
        found = counted.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("all"),
            F.count_if(F.col("n") > sure).alias("sure"),
        ).first()
        if found["sure"] >= k or found["all"] == total:
            return top(counted, "n", "word", k=k)
        if tracked >= MOST_TRACKED:
            plain = heard.groupBy("word").agg(F.count("*").alias("n"))
            return top(plain, "n", "word", k=k)
        tracked = min(2 * tracked, MOST_TRACKED)
