"""Posts and users derived from the given tables.

The tables hold no hashtags, so each event becomes a post: the whole text of a document,
with tags, mentions and links added by rule. All events and all documents take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(divisor: int, choices: dict[int, str]):
    rest = F.col("event_id") % divisor
    picked = F.when(F.lit(False), "")
    for value, words in choices.items():
        picked = picked.when(rest == value, words)
    return picked.otherwise("")


def _user(factor: int):
    """A user of the author's block of 15, so that the network falls apart into blocks."""
    user = F.col("user_id")
    return F.concat(
        F.lit("user"), (user - user % 15 + (F.col("event_id") * factor) % 15).cast("string")
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    documents = table(spark, sf_dir, "documents")
    n_documents = documents.agg(F.count("*")).scalar()
    body = documents.select("doc_id", F.col("text").alias("body"), "lang")
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", (event % n_documents).alias("doc_id")
    )
    # Posts of the placeholder user would link all blocks.
    linked = event % 97 != 0
    text = F.concat(
        F.when(linked & (event % 5 == 1), F.concat(F.lit("RT @"), _user(7), F.lit(": "))).otherwise(""),
        F.col("body"),
        _pick(6, {0: " great", 1: " terrible", 2: " good", 3: " not bad"}),
        _pick(7, {0: " #AI", 1: " #tech #AI", 2: " #music!", 3: " #Café2025"}),
        _pick(11, {0: " #NYC", 1: " #London", 2: " #Bombay #Mumbai", 3: " #Bengaluru"}),
        F.when(linked & (event % 3 == 0), F.concat(F.lit(" @"), _user(13))).otherwise(""),
        F.when(linked & (event % 499 == 0), F.concat(F.lit(" @solo"), event.cast("string"))).otherwise(""),
        F.when(event % 8 == 0, F.lit(" cities and mice")).otherwise(""),
        F.when(event % 13 == 0, F.concat(F.lit(" https://t.co/x"), event.cast("string"))).otherwise(""),
    )
    user = F.col("user_id")
    # Both sides by key: broadcasting the events would leave the texts to as many tasks as the
    # document file has splits, and every query works on the texts.
    return events.join(body.hint("merge"), "doc_id").select(
        event.alias("post_id"),
        F.when(event % 101 != 0, text).alias("text"),
        "ts",
        user.alias("author_id"),
        F.when(event % 97 == 0, "0")
        .when(event % 89 == 0, None)
        .otherwise(F.concat(F.lit("user"), user.cast("string")))
        .alias("username"),
        F.when(event % 53 == 0, "N/A")
        .otherwise(((event * 37 + user * 11) % 101).cast("string"))
        .alias("likes"),
        F.when(event % 59 != 0, ((event * 17 + user) % 41).cast("string")).alias("retweets"),
        ((event * 5) % 13).cast("string").alias("replies"),
        (event % 4).cast("string").alias("quotes"),
        "lang",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of all customers; the first authors have none and get the placeholder."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key + 25).alias("id"),
        F.concat(F.lit("user"), (key + 25).cast("string")).alias("username"),
        ((key * 13) % 1000).alias("followers"),
        ((key * 7) % 500).alias("following"),
        (key * 3).alias("total_posts"),
    )


def payload_pages(posts: DataFrame, users: DataFrame, per_page: int = 100) -> DataFrame:
    """Nest posts and their authors into API pages of ``per_page`` posts, as JSON text."""
    profile = F.struct(
        F.col("id"),
        F.col("u.username").alias("username"),
        F.struct(
            F.col("followers").alias("followers_count"),
            F.col("following").alias("following_count"),
            F.col("total_posts").alias("tweet_count"),
        ).alias("public_metrics"),
    )
    post = F.struct(
        F.col("post_id").alias("id"),
        F.col("text"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("author_id"),
        F.col("lang"),
        F.struct(
            F.col("likes").try_cast("int").alias("like_count"),
            F.col("retweets").try_cast("int").alias("retweet_count"),
            F.col("replies").try_cast("int").alias("reply_count"),
            F.col("quotes").try_cast("int").alias("quote_count"),
        ).alias("public_metrics"),
    )
    page = F.floor(F.col("post_id") / per_page).alias("page")
    # The texts move once, to their pages; profiles meet the authors of a page without them.
    authors = posts.select(page, "author_id").distinct()
    profiles = authors.join(users.alias("u"), F.col("author_id") == F.col("id")).select(
        "page", profile.alias("user")
    )
    told = posts
    repeated = users.groupBy("id").agg(F.count("*").alias("copies")).filter("copies > 1")
    if not repeated.isEmpty():
        # A post is there once for each profile of its author.
        found = posts.join(repeated, F.col("author_id") == F.col("id"), "left")
        each = F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))
        told = found.withColumn("_copy", F.explode(each)).select(*posts.columns)
    none = F.lit(None)
    rows = told.select(page, post.alias("post")).withColumn("user", none.cast(profiles.schema["user"].dataType))
    others = profiles.select("page", none.cast(rows.schema["post"].dataType).alias("post"), "user")
    return (
        rows.unionByName(others)
        .repartition("page")
        .groupBy("page")
        .agg(F.collect_list("post").alias("data"), F.collect_set("user").alias("users"))
        .select(F.to_json(F.struct("data", F.struct("users").alias("includes"))).alias("value"))
    )
