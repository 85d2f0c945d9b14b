"""Engagement of posts, authors, users and kinds of content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.functions.metrics import as_int, as_number, post_engagement, present, row_total
from chatterscope.functions.text import content_type
from chatterscope.operators.ranking import count_by, top
from chatterscope.plans.joins import salted_join
from chatterscope.schema import CHART_METRICS, METRICS, MISSING


def cast_metrics(posts: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    names = present(posts, metrics)
    return posts.withColumns({m: as_int(m) for m in names})


def coerce_metrics(posts: DataFrame, metrics: Sequence[str] = CHART_METRICS) -> DataFrame:
    names = present(posts, metrics)
    return posts.withColumns({m: as_number(m) for m in names})


def top_posts(posts: DataFrame, k: int = 10) -> DataFrame:
    """Posts by the sum of their four metrics; a missing metric leaves the sum null."""
    total = post_engagement(present(posts, METRICS))
    scored = posts.select("post_id", "text", total.alias("total_engagement"))
    return top(scored, "total_engagement", "post_id", k=k)


def author_engagement(posts: DataFrame) -> DataFrame:
    names = present(posts, METRICS)
    sums = [F.sum(as_int(m)).alias(f"total_{m}") for m in names]
    per_author = posts.groupBy("author_id").agg(*sums)
    return per_author.withColumn(
        "total_engagement", row_total([F.col(f"total_{m}") for m in names])
    )


def top_authors(posts: DataFrame, k: int = 10) -> DataFrame:
    return top(author_engagement(posts), "total_engagement", "author_id", k=k)


def engaged_posts(posts: DataFrame) -> DataFrame:
    """Posts with at least one retweet, reply or like."""
    likes, retweets, replies = as_int("likes"), as_int("retweets"), as_int("replies")
    return posts.filter((retweets > 0) | (replies > 0) | (likes > 0))


def engagement_totals(posts: DataFrame, metrics: Sequence[str] = CHART_METRICS) -> DataFrame:
    """Long form: one row per metric the table has."""
    names = present(posts, metrics)
    if not names:
        return posts.sparkSession.createDataFrame([], "metric string, total bigint")
    sums = posts.agg(*[F.sum(as_number(m)).cast("bigint").alias(m) for m in names])
    return sums.unpivot([], names, "metric", "total")


def user_engagement(posts: DataFrame, metrics: Sequence[str] = CHART_METRICS) -> DataFrame:
    names = present(posts, metrics)
    per_user = (
        posts.filter(F.col("username").isNotNull())
        .groupBy("username")
        .agg(*[F.sum(as_number(m)).alias(m) for m in names])
    )
    return per_user.withColumn("total_engagement", row_total([F.col(m) for m in names]))


def user_engagement_top(posts: DataFrame, k: int = 15, excluded: str = "0") -> DataFrame:
    """Top k users; the placeholder user is taken out after the cut, so fewer may remain."""
    best = top(user_engagement(posts), "total_engagement", "username", k=k)
    return best.filter(F.trim("username") != excluded)


def most_active_users(posts: DataFrame, k: int = 10) -> DataFrame:
    return top(count_by(posts, "username", output="posts"), "posts", "username", k=k)


def distinct_users(posts: DataFrame) -> DataFrame:
    return posts.select("username").dropna().distinct()


def content_engagement(posts: DataFrame, metrics: Sequence[str] = CHART_METRICS) -> DataFrame:
    names = present(posts, metrics)
    typed = posts.select(content_type(F.col("text")).alias("content_type"), *names)
    return typed.groupBy("content_type").agg(
        *[F.round(F.avg(as_number(m)), 6).alias(f"avg_{m}") for m in names]
    )


def key_metrics(scored: DataFrame, metrics: Sequence[str] = CHART_METRICS) -> DataFrame:
    """One row: posts, distinct users, engagement, positive share in whole percent."""
    names = present(scored, metrics)
    engagement = row_total([as_number(m) for m in names]) if names else F.lit(0.0)
    totals = scored.agg(
        F.count("*").alias("total_posts"),
        F.count_distinct("username").alias("unique_users"),
        F.coalesce(F.sum(engagement), F.lit(0.0)).cast("bigint").alias("total_engagement"),
        F.count_if(F.col("sentiment") == "Positive").alias("positive_posts"),
    )
    share = F.col("positive_posts") / F.nullif("total_posts", F.lit(0)) * 100
    return totals.select(
        "total_posts",
        "unique_users",
        "total_engagement",
        F.coalesce(F.floor(share), F.lit(0)).cast("bigint").alias("positive_percent"),
    )


def posts_with_users(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Posts with their author's profile, a placeholder where the author is unknown.

    Of a user listed more than once the row of most posts wins, then of most followers, most
    followed, and the later name. Prolific authors are salted.
    """
    profile = ["username", "followers", "following", "total_posts"]
    rank = F.struct("total_posts", "followers", "following", "username")
    unique = (
        users.filter(F.col("id").isNotNull())
        .groupBy(F.col("id").alias("author_id"))
        .agg(F.max(rank).alias("best"))
        .select("author_id", *[F.col(f"best.{c}").alias(c) for c in profile])
    )
    kept = posts.select(*[c for c in posts.columns if c not in profile])
    joined = salted_join(kept, unique, "author_id", "left", by=["post_id"])
    missing = F.lit(MISSING)
    return joined.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), missing) for c in profile}
    )
