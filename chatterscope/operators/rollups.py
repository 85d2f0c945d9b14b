"""One shared roll-up by day, from which the charts follow, and its refresh for changed days.

Every post states a few facts: itself, its sentiment, place, user and hashtags. They are counted
by day in one pass and one aggregation, and kept by day. Counts and sums of days add up, so
charts of any span read the roll-up alone, and a changed day is counted again on its own.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatterscope.functions.metrics import as_number, present, row_total
from chatterscope.operators.ranking import top
from chatterscope.operators.trends import share_of
from chatterscope.plans.features import TAGS, with_sentiment, with_tags_and_place
from chatterscope.schema import CHART_METRICS

TOTAL, SENTIMENT, PLACE, USER, HASHTAG = "total", "sentiment", "place", "user", "hashtag"
ROLLUP = "day date, kind string, item string, part string, n bigint, engagement double"


def _fact(kind: str, item: Column, engagement: Column, part: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        item.alias("item"),
        (F.lit("") if part is None else part).alias("part"),
        engagement.alias("engagement"),
    )


def daily_rollup(posts: DataFrame, metrics: Sequence[str] = CHART_METRICS) -> DataFrame:
    """(day, kind, item, part, n, engagement): how often each fact holds on each day.

    Kinds are total, sentiment, place (``part`` is the sentiment), user and hashtag; a null
    place, user or hashtag is no fact. A null time is a null day.
    """
    names = present(posts, metrics)
    engagement = row_total([as_number(m) for m in names]) if names else F.lit(0.0)
    none = F.lit(0.0)
    scored = with_tags_and_place(with_sentiment(posts)).select(
        F.to_date("ts").alias("day"),
        engagement.alias("engagement"),
        "sentiment",
        "location_name",
        "username",
        F.col(TAGS).alias("hashtags"),
    )
    own = F.array(
        _fact(TOTAL, F.lit(""), F.col("engagement")),
        _fact(SENTIMENT, F.col("sentiment"), none),
        _fact(PLACE, F.col("location_name"), none, F.col("sentiment")),
        _fact(USER, F.col("username"), F.col("engagement")),
    )
    tags = F.transform("hashtags", lambda t: _fact(HASHTAG, t, none))
    facts = scored.select("day", F.explode(F.concat(own, tags)).alias("f")).select("day", "f.*")
    # Nulls go after counting: a filter would be pushed below what computes them.
    counted = facts.groupBy("day", "kind", "item", "part").agg(
        F.count("*").alias("n"), F.sum("engagement").alias("engagement")
    )
    return counted.filter(F.col("item").isNotNull())


def write_rollup(posts: DataFrame, path: str) -> None:
    """The roll-up of all posts, kept by day."""
    _by_day(daily_rollup(posts)).parquet(path)


def _by_day(rollup: DataFrame):
    return rollup.hint("rebalance", "day").write.partitionBy("day")


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLLUP).parquet(path)


def refresh_rollup(
    spark: SparkSession, posts_path: str, path: str, days: Sequence[datetime.date | None]
) -> None:
    """Count ``days`` again from posts kept by day; only their folders are read and written.

    A day without posts any more keeps an empty total, so its old counts go.
    """
    known = [d for d in days if d is not None]
    wanted = F.col("day").isin(known)
    if len(known) < len(days):
        wanted = wanted | F.col("day").isNull()
    changed = daily_rollup(spark.read.parquet(posts_path).filter(wanted))
    empty = spark.createDataFrame([(d, TOTAL, "", "", 0, 0.0) for d in days], ROLLUP)
    rows = changed.select(*empty.columns).unionAll(empty)
    _by_day(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _of(rollup: DataFrame, kind: str, *keys: str) -> DataFrame:
    facts = rollup.filter(F.col("kind") == kind)
    return facts.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n > 0")


def key_metrics(rollup: DataFrame) -> DataFrame:
    """Posts, distinct users, engagement, and positive share in whole percent."""
    users = _of(rollup, USER, "item").agg(F.count("*").alias("unique_users"))
    kind = F.col("kind")
    totals = rollup.agg(
        F.coalesce(F.sum(F.when(kind == TOTAL, F.col("n"))), F.lit(0)).alias("total_posts"),
        F.coalesce(F.sum(F.when(kind == TOTAL, F.col("engagement"))), F.lit(0.0))
        .cast("bigint")
        .alias("total_engagement"),
        F.sum(F.when((kind == SENTIMENT) & (F.col("item") == "Positive"), F.col("n"))).alias("good"),
    )
    share = F.floor(F.col("good") / F.nullif("total_posts", F.lit(0)) * 100)
    return totals.select(
        "total_posts",
        users.scalar().alias("unique_users"),
        "total_engagement",
        F.coalesce(share, F.lit(0)).cast("bigint").alias("positive_percent"),
    )


def user_growth(rollup: DataFrame) -> DataFrame:
    """(day, new_users, cumulative_users) from the first day of each user."""
    users = rollup.filter((F.col("kind") == USER) & F.col("day").isNotNull() & (F.col("n") > 0))
    first = users.groupBy("item").agg(F.min("day").alias("day"))
    daily = first.groupBy("day").agg(F.count("*").alias("new_users"))
    running = W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily.withColumn("cumulative_users", F.sum("new_users").over(running))


def charts(rollup: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The count charts by name, all from the roll-up."""
    places = _of(rollup, PLACE, "item", "part")
    per_place = places.groupBy("item").agg(F.sum("n").alias("n"))
    busiest = top(per_place, "n", "item", k=k)
    days = _of(rollup, SENTIMENT, "day", "item").filter(F.col("day").isNotNull())
    return {
        "top_hashtags": top(_of(rollup, HASHTAG, "item"), "n", "item", k=k),
        "sentiment_distribution": _of(rollup, SENTIMENT, "item"),
        "sentiment_trends": share_of(days, "day"),
        "location_counts": busiest,
        "geo_sentiment": share_of(places, "item").join(
            F.broadcast(busiest.select("item")), "item", "left_semi"
        ),
        "most_active_users": top(_of(rollup, USER, "item"), "n", "item", k=k),
        "user_growth": user_growth(rollup),
        "key_metrics": key_metrics(rollup).unpivot([], METRIC_NAMES, "item", "n"),
    }


METRIC_NAMES = ["total_posts", "unique_users", "total_engagement", "positive_percent"]
CHART = "chart string, day string, item string, part string, n bigint, value double"


def chart_rows(rollup: DataFrame, k: int = 10) -> DataFrame:
    """All charts as one table (chart, day, item, part, n, value), written or shown in one job.

    ``value`` is a percentage, or the running total of ``user_growth``.
    """

    def long(name: str, chart: DataFrame) -> DataFrame:
        def column(wanted: str, kind: str, otherwise: str = "") -> Column:
            found = next((c for c in (wanted, otherwise) if c in chart.columns), None)
            return (F.lit(None) if found is None else F.col(found)).cast(kind)

        return chart.select(
            F.lit(name).alias("chart"),
            column("day", "string").alias("day"),
            column("item", "string").alias("item"),
            column("part", "string").alias("part"),
            column("n", "bigint", "new_users").alias("n"),
            column("percentage", "double", "cumulative_users").alias("value"),
        )

    whole = None
    for name, chart in charts(rollup, k).items():
        rows = long(name, chart)
        whole = rows if whole is None else whole.unionAll(rows)
    return whole
