"""Places named by hashtags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.functions.text import space_tokens, strip
from chatterscope.operators.ranking import count_by, top
from chatterscope.operators.trends import share_of
from chatterscope.plans.lineage import cut_lineage

MAX_BROADCAST_PLACES = 100_000


def city_mentions(posts: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Mentions per place: each blank-separated token that is exactly a place's tag."""
    places = schema.places(posts.sparkSession) if places is None else places
    names = places.select("tag", F.col("place").alias("city"))
    checked = (
        names.limit(MAX_BROADCAST_PLACES + 1)
        .agg(F.count("*").alias("n"), F.bool_and(F.col("tag").startswith("#")).alias("signed"))
        .first()
    )
    tokens = posts.select(F.explode(space_tokens(F.col("text"))).alias("token"))
    if checked["n"] <= MAX_BROADCAST_PLACES:
        if checked["signed"]:
            # No other token can match, so the rest need not be trimmed and probed.
            tokens = tokens.filter(F.col("token").contains("#"))
        tags = tokens.select(strip(F.col("token")).alias("tag"))
        return count_by(tags.join(F.broadcast(names), "tag"), "city")
    # A dimension beyond the broadcast bound meets counted tags, so no tag is hot.
    tags = tokens.select(strip(F.col("token")).alias("tag"))
    return count_by(tags, "tag").join(names, "tag").groupBy("city").agg(F.sum("n").alias("n"))


def city_top(posts: DataFrame, k: int = 20, places: DataFrame | None = None) -> DataFrame:
    return top(city_mentions(posts, places), "n", "city", k=k)


def location_counts(placed: DataFrame, k: int = 10) -> DataFrame:
    return top(count_by(placed, "location_name"), "n", "location_name", k=k)


def geo_sentiment(placed: DataFrame, k: int = 10) -> DataFrame:
    """Sentiment shares of the k places with most posts.

    The roll-up (a row per place and sentiment) is kept, so that the texts are read once.
    """
    counts = cut_lineage(count_by(placed, "location_name", "sentiment"))
    totals = counts.groupBy("location_name").agg(F.sum("n").alias("n"))
    best = top(totals, "n", "location_name", k=k).select("location_name")
    return share_of(counts, "location_name").join(
        F.broadcast(best), "location_name", "left_semi"
    )


def geo_center(placed: DataFrame) -> DataFrame:
    """Mean position of the posts that have one."""
    return placed.agg(
        F.round(F.avg("latitude"), 6).alias("latitude"),
        F.round(F.avg("longitude"), 6).alias("longitude"),
    )


def geo_density(placed: DataFrame, step: float = 10.0) -> DataFrame:
    """Posts per grid cell of ``step`` degrees."""
    cells = placed.select(
        F.floor(F.col("latitude") / step).cast("bigint").alias("lat_cell"),
        F.floor(F.col("longitude") / step).cast("bigint").alias("lon_cell"),
    )
    return count_by(cells, "lat_cell", "lon_cell")


def location_markers(placed: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest places with their most used hashtag, position and popup text."""
    per_tag = (
        placed.groupBy("location_name", "location_hashtag")
        .agg(
            F.count("latitude").alias("n"),
            F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude"),
        )
        .filter(F.col("n") > 0)
    )
    per_place = per_tag.groupBy("location_name").agg(
        F.sum("n").alias("n"),
        F.min(F.struct((-F.col("n")).alias("rank"), "location_hashtag"))["location_hashtag"].alias(
            "top_hashtag"
        ),
        F.min("latitude").alias("latitude"),
        F.min("longitude").alias("longitude"),
    )
    popup = F.format_string("%s: %d posts, top hashtag %s", "location_name", "n", "top_hashtag")
    return top(per_place, "n", "location_name", k=k).withColumn("popup", popup)
