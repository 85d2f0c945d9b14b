"""Hashtags, words, terms and sentiment, in total and over time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.functions import text, words
from chatterscope.operators.ranking import count_by, explode_names, top
from chatterscope.plans.joins import ROW_KEY, among, with_row_key
from chatterscope.plans.lineage import cut_lineage


def hashtag_counts(posts: DataFrame) -> DataFrame:
    tags = explode_names(posts, text.extract_hashtags(F.col("text")), "hashtag")
    return count_by(tags, "hashtag")


def top_hashtags(posts: DataFrame, k: int = 10) -> DataFrame:
    return top(hashtag_counts(posts), "n", "hashtag", k=k)


def token_array_counts(posts: DataFrame) -> DataFrame:
    """Posts per whole token sequence; equal sequences are equal texts, so group by text.

    Digests are counted first: a text that is there once stays where it is.
    """
    texts = with_row_key(posts.select("text"))
    counted = texts.groupBy(*ROW_KEY).agg(F.count("*").alias("n"))
    copies = cut_lineage(counted.filter(F.col("n") > 1).select(*ROW_KEY))
    n = copies.count()
    per_text = among(texts, copies, n, "left_semi").groupBy("text").agg(F.count("*").alias("n"))
    once = among(texts, copies, n, "left_anti").select("text", F.lit(1).cast("bigint").alias("n"))
    per_text = per_text.unionAll(once)
    return per_text.select(text.space_tokens(F.col("text")).alias("tokens"), "n")


def counted_words(texts: DataFrame, split: Callable, count: Callable, *sums: str) -> DataFrame:
    """(word, and ``sums``) over a table of one text column: counted by the tasks, then added up.

    ``split`` and ``count`` are of ``functions.words``: from texts to words, from these to counts.
    """
    kinds = ", ".join(f"{name} long" for name in sums)
    counted = texts.mapInArrow(words.by_batch(split, count), f"word string, {kinds}")
    return counted.groupBy("word").agg(*[F.sum(name).alias(name) for name in sums])


def word_frequencies(
    posts: DataFrame, k: int = 200, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """Most frequent words of two or more characters in the clean texts."""
    stopwords = schema.stopwords() if stopwords is None else stopwords
    counted = counted_words(posts.select("text"), words.clean, words.totals, "n")
    kept = counted.filter((F.length("word") >= 2) & ~F.col("word").isin(list(stopwords)))
    return top(kept, "n", "word", k=k)


def term_statistics(posts: DataFrame, stopwords: Sequence[str] | None = None) -> DataFrame:
    """(term, n, df): occurrences and number of posts, terms having two or more characters.

    Both are counted inside the task before anything moves: no shuffle by post.
    """
    stopwords = schema.stopwords() if stopwords is None else stopwords
    counted = counted_words(posts.select("text"), words.clean, words.statistics, "n", "df")
    counted = counted.withColumnRenamed("word", "term")
    return counted.filter((F.length("term") >= 2) & ~F.col("term").isin(list(stopwords)))


def term_counts(
    posts: DataFrame,
    k: int = 15,
    vocabulary: int = 50,
    min_df: int = 2,
    stopwords: Sequence[str] | None = None,
) -> DataFrame:
    frequent = term_statistics(posts, stopwords).filter(F.col("df") >= min_df)
    best = top(frequent, "n", "term", k=vocabulary)
    return top(best.select("term", "n"), "n", "term", k=k)


def bag_of_words(posts: DataFrame) -> DataFrame:
    """(post_id, term, n) over the non-blank clean texts.

    Words of one post are counted inside its row. No shuffle, however long a text is.
    """
    bag = words.column(
        words.bags, "array<struct<term: string, n: bigint>>", text.clean_words(F.col("text"))
    )
    return posts.select("post_id", F.inline(bag))


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    return count_by(scored, "sentiment")


def _day(c: str = "ts"):
    return F.to_date(c)


def _day_text(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias("day")


def hashtag_trends(posts: DataFrame, k: int = 5) -> DataFrame:
    """Daily counts of the k most used hashtags; days without one count 0.

    The (day, hashtag) roll-up is kept, so that ranking, series and the first and last day
    read the texts once; a post without hashtags is there under a null one.
    """
    tags = posts.select(
        _day().alias("date"),
        F.explode_outer(text.extract_hashtags(F.col("text"))).alias("hashtag"),
    )
    rollup = cut_lineage(tags.groupBy("date", "hashtag").agg(F.count("*").alias("n")))
    daily = rollup.filter(F.col("hashtag").isNotNull())
    best = top(daily.groupBy("hashtag").agg(F.sum("n").alias("n")), "n", "hashtag", k=k)
    span = rollup.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last")))
    calendar = best.select("hashtag", span.scalar().alias("span")).select(
        "hashtag", F.explode(F.sequence("span.first", "span.last")).alias("date")
    )
    few = daily.join(F.broadcast(best.select("hashtag")), "hashtag", "left_semi")
    series = calendar.join(few, ["date", "hashtag"], "left")
    return series.select(_day_text("date"), "hashtag", F.coalesce("n", F.lit(0)).alias("n"))


def share_of(df: DataFrame, within: str, output: str = "percentage") -> DataFrame:
    """Add each row's share of its group's ``n`` in percent."""
    total = F.sum("n").over(W.partitionBy(within))
    return df.withColumn(output, F.round(F.col("n") / total * 100, 6))


def sentiment_trends(scored: DataFrame) -> DataFrame:
    daily = count_by(scored.select(_day().alias("date"), "sentiment"), "date", "sentiment")
    return share_of(daily, "date").select(_day_text("date"), "sentiment", "n", "percentage")


def user_growth(posts: DataFrame) -> DataFrame:
    """New users per day of their first post, and the running total.

    The running total is one ordered window over the daily roll-up: a row per calendar day.
    """
    first = (
        posts.filter(F.col("username").isNotNull() & F.col("ts").isNotNull())
        .groupBy("username")
        .agg(F.min(_day()).alias("date"))
    )
    daily = first.groupBy("date").agg(F.count("*").alias("new_users"))
    running = W.orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily.withColumn("cumulative_users", F.sum("new_users").over(running)).select(
        _day_text("date"), "new_users", "cumulative_users"
    )


def posts_by(posts_with_time: DataFrame, unit: str) -> DataFrame:
    """Posts per ``hour`` or ``day_of_week``."""
    return count_by(posts_with_time, unit)
