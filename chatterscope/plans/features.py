"""Feature columns that the reports are built on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.functions import sentiment, text, words
from chatterscope.functions.dictionary import MAX_INLINE_ENTRIES, inline_lookup
from chatterscope.plans.joins import (
    CONTENT,
    contents,
    lookup_tokens,
    salted_join,
    sent_entries,
    sent_or_salted,
    values_of,
    with_content,
)
from chatterscope.plans.lineage import cut_lineage


def cleaned_words(posts: DataFrame) -> Column:
    """The words of the clean text, which is taken from the table where it is there already."""
    if "clean_text" in posts.columns:
        return text.clean_tokens(F.col("clean_text"))
    return text.clean_words(F.col("text"))


def words_of(posts: DataFrame) -> tuple[DataFrame, Callable]:
    """The column that ``cleaned_words`` reads, and how to split its batches into words."""
    if "clean_text" in posts.columns:
        return posts.select("clean_text"), words.split
    return posts.select("text"), words.clean


def with_clean_text(posts: DataFrame, ascii_only: bool = False) -> DataFrame:
    return posts.withColumn("clean_text", text.clean_text(F.col("text"), ascii_only))


def with_sentiment(
    posts: DataFrame,
    lexicon: DataFrame | None = None,
    negators: Sequence[str] = schema.NEGATORS,
    inline_limit: int = MAX_INLINE_ENTRIES,
) -> DataFrame:
    """Add ``sentiment_score`` and ``sentiment`` from a (word, polarity) lexicon.

    A lexicon of checked size is looked up inside the row, as a constant or sent to the tasks; a
    larger one is joined.
    """
    lexicon = schema.lexicon(posts.sparkSession) if lexicon is None else lexicon
    lexicon = lexicon.select("word", F.col("polarity").cast("double").alias("polarity"))
    worded = posts.withColumn("_words", cleaned_words(posts))
    find = inline_lookup(lexicon, "word", inline_limit)
    if find is not None:
        score = sentiment.polarity(F.col("_words"), find.firsts(), negators)
        scored = worded.withColumn("sentiment_score", score)
    else:
        known = cut_lineage(values_of(lexicon, "word", "polarity"))
        sent = sent_entries(known)
        if sent is not None:
            score = sentiment.polarity(F.col("_words"), sent, negators)
            scored = worded.withColumn("sentiment_score", score)
        else:
            scored = _joined_sentiment(worded, known, negators)
    return scored.withColumn("sentiment", sentiment.label(F.col("sentiment_score"))).drop("_words")


def _joined_sentiment(
    worded: DataFrame, known: DataFrame, negators: Sequence[str]
) -> DataFrame:
    """``sentiment_score`` by a join: each distinct list of words is counted by word and
    whether a negator stands before, and comes back as a sum and a number of hits."""
    named = with_content(worded, "_words")
    counted = (
        contents(named, "_words")
        .withColumn("_items", sentiment.negated(F.col("_words"), negators))
        .select(*CONTENT, F.inline("_items"))
        .groupBy(*CONTENT, "token", "negated")
        .agg(F.count("*").alias("n"))
    )
    found = salted_join(counted, known, "token", by=CONTENT)
    sign = F.when(F.col("negated"), sentiment.NEGATION).otherwise(1.0)
    means = found.groupBy(*CONTENT).agg(
        (F.sum(F.col("value") * sign * F.col("n")) / F.sum("n")).alias("_mean")
    )
    return (
        named.join(means, CONTENT, "left")
        .withColumn("sentiment_score", F.coalesce("_mean", F.lit(0.0)))
        .drop("_mean", *CONTENT)
    )


def with_tokens(
    posts: DataFrame,
    stopwords: Sequence[str] | None = None,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """Add ``tokens``: alphabetic words of the clean text without stop words, as lemmas."""
    stopwords = schema.stopwords() if stopwords is None else stopwords
    lemmas = schema.lemmas(posts.sparkSession) if lemmas is None else lemmas
    words = text.alphabetic_tokens(cleaned_words(posts), stopwords)
    return lemmatize(posts.withColumn("tokens", words), lemmas)


def lemmatize(df: DataFrame, lemmas: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Replace each token by its lemma; unknown forms stay as they are."""
    found = lookup_tokens(df, tokens, lemmas, "form", "lemma")
    if found.entries is not None:
        return df.withColumn(tokens, text.replaced(F.col(tokens), found.entries))
    return found.df.withColumn(
        tokens, F.transform(tokens, lambda t: F.coalesce(found.value(t), found.token(t)))
    )


PLACE = "struct<hashtag: string, at: struct<place: string, lat: double, lon: double>>"


def with_place(
    posts: DataFrame,
    places: DataFrame | None = None,
    inline_limit: int = MAX_INLINE_ENTRIES,
) -> DataFrame:
    """Add ``location_hashtag``, ``location_name``, ``latitude`` and ``longitude``: the place of
    the first hashtag that names one.

    Places of checked number are looked up inside the row, more are joined.
    """
    return with_tags_and_place(posts, places, inline_limit).drop(TAGS)


# The hashtags that ``with_tags_and_place`` adds.
TAGS = "_tags"


def with_tags_and_place(
    posts: DataFrame,
    places: DataFrame | None = None,
    inline_limit: int = MAX_INLINE_ENTRIES,
) -> DataFrame:
    """``with_place`` with the hashtags of the text, for reports that need both."""
    places = schema.places(posts.sparkSession) if places is None else places
    places = places.select("tag", "place", "lat", "lon")
    tagged = posts.withColumn(TAGS, text.extract_hashtags(F.col("text")))
    find = inline_lookup(places, "tag", inline_limit)
    if find is not None:
        named = F.transform(
            F.col(TAGS),
            lambda h: F.struct(h.alias("hashtag"), find(F.concat(F.lit("#"), h)).alias("at")),
        )
        first = F.get(F.filter(named, lambda t: t["at"].isNotNull()), F.lit(0)).cast(PLACE)
        placed = tagged.withColumn("_place", first)
    else:
        placed = _joined_place(tagged, places)
    return (
        placed.withColumn("location_hashtag", F.col("_place.hashtag"))
        .withColumn("location_name", F.col("_place.at.place"))
        .withColumn("latitude", F.col("_place.at.lat"))
        .withColumn("longitude", F.col("_place.at.lon"))
        .drop("_place")
    )


def _joined_place(tagged: DataFrame, places: DataFrame) -> DataFrame:
    """``_place`` by a join: each distinct list of hashtags meets the places once."""
    known = places.select("tag", F.struct("place", "lat", "lon").alias("at"))
    named = with_content(tagged, TAGS)
    rows = contents(named, TAGS).select(*CONTENT, F.posexplode(TAGS).alias("_pos", "hashtag"))
    found = sent_or_salted(
        rows.withColumn("token", F.concat(F.lit("#"), "hashtag")),
        cut_lineage(values_of(known, "tag", "at")),
        "token",
        by=CONTENT,
    )
    first = found.groupBy(*CONTENT).agg(
        F.min_by(F.struct("hashtag", F.col("value").alias("at")), "_pos").cast(PLACE).alias("_place")
    )
    return named.join(first, CONTENT, "left").drop(*CONTENT)


def with_time(posts: DataFrame) -> DataFrame:
    """Add ``date``, ``hour`` and ``day_of_week`` (Sunday is 1)."""
    return posts.withColumns(
        {"date": F.to_date("ts"), "hour": F.hour("ts"), "day_of_week": F.dayofweek("ts")}
    )


def enrich(
    posts: DataFrame,
    stopwords: Sequence[str] | None = None,
    lexicon: DataFrame | None = None,
    lemmas: DataFrame | None = None,
    places: DataFrame | None = None,
) -> DataFrame:
    """All feature columns; a report that needs some of them pays for those only."""
    extracted = with_clean_text(posts).withColumns(
        {
            "hashtags": text.extract_hashtags(F.col("text")),
            "mentions": text.extract_mentions(F.col("text")),
            "content_type": text.content_type(F.col("text")),
        }
    )
    scored = with_sentiment(with_tokens(extracted, stopwords, lemmas), lexicon)
    return with_time(with_place(scored, places))
