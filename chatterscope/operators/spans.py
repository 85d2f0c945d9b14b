"""Distinct users of any span of days, from a mergeable sketch kept for each day."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Log of the sketch's buckets: its standard error is 1.04 / sqrt(2 ** BUCKETS).
BUCKETS = 12
DEVIATIONS = 4


def error_bound(buckets: int = BUCKETS) -> float:
    """Relative error of an estimate that is not passed but in rare cases."""
    return DEVIATIONS * 1.04 / math.sqrt(1 << buckets)


def user_sketches(posts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(day, users): a sketch of the users of each day, a few KB whatever their number.

    Posts without a time or a user are left out.
    """
    known = posts.filter(F.col("username").isNotNull() & F.col("ts").isNotNull())
    return known.groupBy(F.to_date("ts").alias("day")).agg(
        F.hll_sketch_agg("username", F.lit(buckets)).alias("users")
    )


def unique_users(sketches: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """One row: the estimated number of users from ``first`` to ``last``, without the posts."""
    span = sketches.filter(F.col("day").between(F.lit(first), F.lit(last)))
    return span.agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("users")
    )


def _spans(days: DataFrame, length: int) -> DataFrame:
    """Each row in the spans that hold its day, a span being named by its last day."""
    return days.withColumn("span", F.explode(F.sequence("day", F.date_add("day", length - 1))))


def unique_users_by_span(posts: DataFrame, days: int = 7) -> DataFrame:
    """(day, users, estimate): users of the ``days`` days up to each day that has posts of users.

    ``users`` is counted from one row for each user and day, ``estimate`` is merged from the days'
    sketches.
    """
    known = posts.filter(F.col("username").isNotNull() & F.col("ts").isNotNull())
    daily = known.select(F.to_date("ts").alias("day"), "username").distinct()
    exact = _spans(daily, days).groupBy("span").agg(F.count_distinct("username").alias("users"))
    sketches = user_sketches(posts)
    merged = _spans(sketches, days).groupBy("span").agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("estimate")
    )
    ends = sketches.select(F.col("day").alias("span"))
    return ends.join(exact, "span").join(merged, "span").select(
        F.date_format("span", "yyyy-MM-dd").alias("day"), "users", "estimate"
    )
