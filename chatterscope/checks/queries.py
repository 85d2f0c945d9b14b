"""Registered queries: one per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.checks import fixtures
from chatterscope.functions import metrics, sentiment, text, words
from chatterscope.operators import (
    communities,
    components,
    dictionaries,
    engagement,
    geo,
    graph,
    heavy,
    rollups,
    spans,
    tables,
    topics,
    trends,
)
from chatterscope.plans import features
from chatterscope.plans.lineage import cut_lineage, scratch_path
from chatterscope.sources import indexed
from chatterscope.sources import posts as sources
from chatterscope.streaming import commits
from chatterscope.streaming import hashtags as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def on_posts(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(fixtures.posts(spark, sf_dir))

    QUERIES[name] = run


def per_post(name: str, column) -> None:
    on_posts(name, lambda p: p.select("post_id", column().alias("value")))


def spaced(tokens):
    return F.array_join(tokens, " ")


# Sources and sinks


def seconds():
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")


def _shown(p: DataFrame) -> DataFrame:
    metric_columns = [F.col(m) for m in schema.METRICS]
    return p.select("post_id", "text", seconds(), "author_id", "username", *metric_columns, "lang")


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sources.write_csv_posts(fixtures.posts(spark, sf_dir), path, compression="gzip")
    return _shown(sources.load_posts(spark, path, "csv"))


@query
def flatten_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "payload")
    pages = fixtures.payload_pages(fixtures.posts(spark, sf_dir), fixtures.users(spark, sf_dir))
    sources.write_payload(pages, path)
    flat = sources.load_posts(spark, path, "payload")
    return flat.withColumn("ts", seconds())


@query
def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts per tag of the place dimension, every tag of it included."""
    tags = trends.hashtag_counts(fixtures.posts(spark, sf_dir)).select(
        F.concat(F.lit("#"), "hashtag").alias("tag"), "n"
    )
    return (
        schema.places(spark)
        .join(tags, "tag", "left")
        .select("tag", "place", "lat", "lon", F.coalesce("n", F.lit(0)).alias("n"))
    )


on_posts("posts_to_lines", sources.posts_to_lines)


# Projections, filters, text functions

on_posts("top_posts", engagement.top_posts)
on_posts(
    "metrics_cast", lambda p: engagement.cast_metrics(p).select("post_id", *schema.METRICS)
)
on_posts(
    "metrics_coerced",
    lambda p: engagement.coerce_metrics(p).select("post_id", *schema.CHART_METRICS),
)
on_posts("engaged_posts", lambda p: engagement.engaged_posts(p).select("post_id", "username"))


@query
def search_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hits in a table that was loaded from API pages."""
    path = scratch_path(spark, "payload")
    pages = fixtures.payload_pages(fixtures.posts(spark, sf_dir), fixtures.users(spark, sf_dir))
    sources.write_payload(pages, path)
    hits = tables.search_posts(sources.load_posts(spark, path, "payload"))
    return hits.select("post_id", "author_id", "text")


per_post("clean_text_ascii", lambda: text.clean_text(F.col("text"), ascii_only=True))
per_post("clean_text_unicode", lambda: text.clean_text(F.col("text")))
per_post(
    "remove_stopwords",
    lambda: spaced(text.without(text.clean_words(F.col("text"), True), schema.stopwords())),
)
per_post("extract_hashtags", lambda: spaced(text.extract_hashtags(F.col("text"))))
per_post("extract_mentions", lambda: spaced(text.extract_mentions(F.col("text"))))
per_post("whitespace_tokens", lambda: spaced(text.word_tokens(F.col("text"))))
per_post("content_types", lambda: text.content_type(F.col("text")))
on_posts("tokens", lambda p: features.with_tokens(p).select("post_id", spaced("tokens").alias("value")))


@query
def lemmatize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemmas of the plain word tokens, and how often each appears."""
    words = fixtures.posts(spark, sf_dir).select(
        "post_id", text.clean_words(F.col("text")).alias("tokens")
    )
    lemmas = spark.createDataFrame(
        [("ands", "and"), ("hes", "he"), ("ing", "ings"), ("great", "greatness")],
        "form string, lemma string",
    )
    return features.lemmatize(words, lemmas.unionByName(schema.lemmas(spark))).select(
        "post_id", spaced("tokens").alias("value")
    )


on_posts(
    "time_features",
    lambda p: features.with_time(p).select(
        "post_id", F.date_format("date", "yyyy-MM-dd").alias("day"), "hour", "day_of_week"
    ),
)


# Sentiment

on_posts(
    "sentiment_score",
    lambda p: features.with_sentiment(p).select(
        "post_id", F.round("sentiment_score", 9).alias("score")
    ),
)


# Dictionaries learned from the feed

on_posts("lexicon_learned", dictionaries.learn_lexicon)
on_posts("lemma_rules", lambda p: dictionaries.learn_lemmas(dictionaries.vocabulary(p)))


@query
def sentiment_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts by label under the lexicon that the posts themselves taught."""
    p = fixtures.posts(spark, sf_dir)
    scored = features.with_sentiment(p, dictionaries.learn_lexicon(p))
    return scored.groupBy("sentiment").agg(F.count("*").alias("n"))


@query
def lemmatize_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each post as lemmas by rule."""
    p = fixtures.posts(spark, sf_dir)
    lemmas = dictionaries.learn_lemmas(dictionaries.vocabulary(p))
    return features.with_tokens(p, lemmas=lemmas).select("post_id", spaced("tokens").alias("value"))


# Dictionaries of all words of the documents, over a feed that holds posts twice: the join routes.


def known_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(distinct_words(fixtures.table(spark, sf_dir, "documents")))


def distinct_words(texts: DataFrame) -> DataFrame:
    """(word): every word of the clean texts, each once."""
    return trends.counted_words(texts.select("text"), words.clean, words.totals, "n").select("word")


def repeated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixtures.posts(spark, sf_dir)
    return p.unionAll(engagement.engaged_posts(p))


@query
def sentiment_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    polarity = (F.length("word") * 7 % 21 - 10) / 10
    lexicon = known_words(spark, sf_dir).select("word", polarity.alias("polarity"))
    scored = features.with_sentiment(repeated_feed(spark, sf_dir), lexicon)
    return scored.select("post_id", F.round("sentiment_score", 9).alias("score"))


@query
def lemmatize_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the feed is in the dictionary, which adds an s."""
    texts = repeated_feed(spark, sf_dir)
    feed = texts.select("post_id", text.clean_words(F.col("text")).alias("tokens"))
    known = cut_lineage(known_words(spark, sf_dir).unionByName(distinct_words(texts)).distinct())
    lemmas = known.select(F.col("word").alias("form"), F.concat("word", F.lit("s")).alias("lemma"))
    return features.lemmatize(feed, lemmas).select("post_id", spaced("tokens").alias("value"))


@query
def post_location_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.length("word").cast("double")
    places = (
        known_words(spark, sf_dir)
        .select(
            F.concat(F.lit("#"), "word").alias("tag"),
            F.concat(F.lit("at "), "word").alias("place"),
            size.alias("lat"),
            (-size).alias("lon"),
        )
        .unionByName(schema.places(spark))
        .unionByName(spark.createDataFrame([("#AI", "Lab", 1.0, 2.0)], "tag string, place string, lat double, lon double"))
    )
    return features.with_place(repeated_feed(spark, sf_dir), places).select(
        "post_id", "location_hashtag", "location_name", "latitude", "longitude"
    )


on_posts("sentiment_labels", lambda p: features.with_sentiment(p).select("post_id", "sentiment"))
on_posts(
    "sentiment_distribution", lambda p: trends.sentiment_distribution(features.with_sentiment(p))
)
on_posts("sentiment_trends", lambda p: trends.sentiment_trends(features.with_sentiment(p)))


@query
def score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    def exclamations(texts: pd.Series) -> pd.Series:
        return texts.fillna("").str.count("!").astype("float64")

    scored = sentiment.score_text(fixtures.posts(spark, sf_dir), exclamations)
    return scored.select("post_id", "score")


# Engagement

on_posts("key_metrics", lambda p: engagement.key_metrics(features.with_sentiment(p)))
on_posts("author_engagement", engagement.author_engagement)
on_posts("top_authors", engagement.top_authors)
on_posts("engagement_totals", engagement.engagement_totals)
on_posts("user_engagement_top15", engagement.user_engagement_top)
on_posts("most_active_users", engagement.most_active_users)
on_posts("distinct_users", engagement.distinct_users)
on_posts("content_engagement", engagement.content_engagement)


@query
def posts_with_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = engagement.posts_with_users(
        fixtures.posts(spark, sf_dir), fixtures.users(spark, sf_dir)
    )
    return joined.select(
        "post_id", "author_id", "username", "followers", "following", "total_posts"
    )


# Hashtags, words, time series

on_posts("top_hashtags", trends.top_hashtags)
on_posts(
    "token_array_counts",
    lambda p: trends.token_array_counts(p).select(spaced("tokens").alias("tokens"), "n"),
)
on_posts("word_frequencies", trends.word_frequencies)
on_posts("term_counts", trends.term_counts)
on_posts("bag_of_words", trends.bag_of_words)
on_posts("hashtag_trends", trends.hashtag_trends)
on_posts("user_growth", trends.user_growth)


@query
def unique_users_by_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each seven days, and whether the estimate from sketches is within its bound."""
    found = spans.unique_users_by_span(fixtures.posts(spark, sf_dir))
    off = F.abs(F.col("estimate") - F.col("users"))
    return found.select("day", "users", (off <= F.col("users") * spans.error_bound()).alias("within"))


on_posts("posts_by_hour", lambda p: trends.posts_by(features.with_time(p), "hour"))
on_posts("posts_by_weekday", lambda p: trends.posts_by(features.with_time(p), "day_of_week"))


# Sets


def _overlapping(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two post tables that share rows: all posts, and those with engagement."""
    return p, engagement.engaged_posts(p)


on_posts(
    "merge_dedup",
    lambda p: tables.merge_posts(*_overlapping(p)).select("post_id", "author_id", "text"),
)
on_posts("dedup_stats", lambda p: tables.dedup_stats(tables.union_posts(*_overlapping(p))))


# Places

on_posts("city_mentions", geo.city_mentions)
on_posts("city_top20", geo.city_top)
on_posts(
    "post_location",
    lambda p: features.with_place(p).select(
        "post_id", "location_hashtag", "location_name", "latitude", "longitude"
    ),
)
on_posts("location_counts", lambda p: geo.location_counts(features.with_place(p)))
on_posts(
    "geo_sentiment", lambda p: geo.geo_sentiment(features.with_place(features.with_sentiment(p)))
)
on_posts("location_markers", lambda p: geo.location_markers(features.with_place(p)))
on_posts("geo_center", lambda p: geo.geo_center(features.with_place(p)))
on_posts("geo_density", lambda p: geo.geo_density(features.with_place(p)))


# Graph


def value_edges(p: DataFrame) -> DataFrame:
    return graph.engagement_value_edges(p)


def edges_of(p: DataFrame, choice: str = "all") -> DataFrame:
    if choice != "all":
        p = graph.by_sentiment(features.with_sentiment(p), choice)
    return graph.interaction_edges(p)


def network(p: DataFrame, choice: str = "all") -> DataFrame:
    """Edges kept, for operators that read them several times."""
    return cut_lineage(edges_of(p, choice))


on_posts("engagement_value_edges", value_edges)
on_posts("degree_centrality", lambda p: graph.degree_centrality(value_edges(p)))
on_posts("top_influencers", lambda p: graph.top_influencers(value_edges(p)))
on_posts("influencer_flags", lambda p: graph.influencer_flags(value_edges(p)))
on_posts("interaction_edges", edges_of)
on_posts("interaction_edges_positive", lambda p: edges_of(p, "positive"))
on_posts("interaction_edges_negative", lambda p: edges_of(p, "negative"))
on_posts("edge_posts", graph.edge_posts)
on_posts("interaction_edges_pruned", lambda p: graph.prune(network(p)))
on_posts("interaction_nodes", lambda p: graph.interaction_nodes(network(p)))
on_posts("graph_stats", lambda p: graph.graph_stats(network(p)))
on_posts("top_mentioned", graph.top_mentioned)
on_posts("connected_components", lambda p: components.connected_components(network(p)))
on_posts("communities", lambda p: components.label_propagation(network(p)))
on_posts(
    "community_summary",
    lambda p: components.community_summary(components.label_propagation(network(p)), p),
)
# The names they had beside a labelling of five rounds.
QUERIES["communities_settled"] = QUERIES["communities"]
QUERIES["community_summary_settled"] = QUERIES["community_summary"]


on_posts("community_split", lambda p: communities.split_communities(network(p)))


@query
def communities_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settled communities, numbered from 1 in the order of their names."""
    settled = components.label_propagation(network(fixtures.posts(spark, sf_dir)))
    return communities.number_communities(settled.withColumnRenamed("community", "component"))


# The enriched table: texts are cleaned once, reports read what was written.


def _enriched(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "enriched")
    sources.write_posts(fixtures.posts(spark, sf_dir), path, derive=features.enrich)
    return path


def on_enriched(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(sources.load_posts(spark, _enriched(spark, sf_dir)))

    QUERIES[name] = run


on_enriched("enriched_key_metrics", engagement.key_metrics)
on_enriched("enriched_sentiment_trends", trends.sentiment_trends)
on_enriched("enriched_geo_sentiment", geo.geo_sentiment)


# One roll-up for all charts, and its refresh after a day has changed.


@query
def chart_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rollup")
    rollups.write_rollup(fixtures.posts(spark, sf_dir), path)
    return rollups.chart_rows(rollups.read_rollup(spark, path))


@query
def chart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day comes in part first, is rolled up, completed, and counted again on its own."""
    p = fixtures.posts(spark, sf_dir)
    changed = p.agg(F.date_add(F.min(F.to_date("ts")), 3)).first()[0]
    late = (F.to_date("ts") == F.lit(changed)) & (F.col("post_id") % 2 == 0)
    kept, path = scratch_path(spark, "by-day"), scratch_path(spark, "rollup")
    sources.write_posts(p.filter(~F.coalesce(late, F.lit(False))), kept)
    rollups.write_rollup(sources.load_posts(spark, kept), path)
    sources.rewrite_days(p.filter(F.to_date("ts") == F.lit(changed)), kept)
    rollups.refresh_rollup(spark, kept, path, [changed])
    return rollups.chart_rows(rollups.read_rollup(spark, path))


on_posts("word_frequencies_heavy", heavy.word_frequencies_heavy)


@query
def search_posts_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hits, from the files that hold one of the hashtags."""
    kept, index = scratch_path(spark, "posts"), scratch_path(spark, "tags")
    indexed.write_indexed(fixtures.posts(spark, sf_dir), kept, index)
    hits = indexed.search_indexed(spark, kept, index)
    return hits.select("post_id", "author_id", "text")


# Topics


def fitted(spark: SparkSession, sf_dir: str):
    return topics.fit_topics(fixtures.posts(spark, sf_dir))


@query
def topic_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_model(spark, fitted(spark, sf_dir))


@query
def topic_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_keywords(spark, fitted(spark, sf_dir))


@query
def topic_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_distribution(fitted(spark, sf_dir), fixtures.posts(spark, sf_dir))


@query
def topic_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_evolution(fitted(spark, sf_dir), fixtures.posts(spark, sf_dir))


@query
def topic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the model is fed: how many posts have a text, and how many words, per day."""
    p = fixtures.posts(spark, sf_dir)
    fed = trends.bag_of_words(p).groupBy("post_id").agg(F.sum("n").alias("n"))
    return p.select("post_id", "ts").join(fed, "post_id").groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("day")
    ).agg(F.count("*").alias("posts"), F.sum("n").alias("words"))


@query
def topic_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day: posts with a topic in range, and whether the daily shares make 100 percent."""
    p = fixtures.posts(spark, sf_dir)
    shares = topics.topic_evolution(fitted(spark, sf_dir), p)
    return shares.groupBy("day").agg(
        F.sum(F.when(F.col("topic").between(0, topics.TOPICS - 1), F.col("n"))).alias("posts"),
        (F.abs(F.sum("percentage") - 100) < 1e-4).alias("whole"),
    )


# Streams


@query
def stream_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed all posts as lines, collect the hashtag stream's batches, count them."""
    feed, out = scratch_path(spark, "feed"), scratch_path(spark, "hashtags")
    sources.write_lines(fixtures.posts(spark, sf_dir), feed)
    started = streams.start_hashtags(
        streams.read_lines(spark, feed),
        scratch_path(spark, "stream-state"),
        streams.parquet_batches(out),
        available_now=True,
    )
    started.awaitTermination()
    found = spark.read.schema("hashtag string").parquet(f"{out}/batch=*")
    return found.groupBy("hashtag").agg(F.count("*").alias("n"))


@query
def stream_hashtags_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream, stopped by a failure between a batch's data and its record, started
    again, and read by its records."""
    feed, out = scratch_path(spark, "feed"), scratch_path(spark, "committed")
    state = scratch_path(spark, "stream-state")
    sources.write_lines(fixtures.posts(spark, sf_dir), feed)

    def lost(*_) -> None:
        raise ConnectionError("stopped before the record")

    for writer in (commits.committed_batches(out, lost), commits.committed_batches(out)):
        lines = streams.read_lines(spark, feed)
        started = streams.start_hashtags(lines, state, writer, available_now=True)
        try:
            started.awaitTermination()
        except StreamingQueryException as stopped:
            if "stopped before the record" not in str(stopped):
                raise
    return commits.read_committed(spark, out).groupBy("hashtag").agg(F.count("*").alias("n"))


@query
def stream_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream all posts by day windows; a last row closes the feed, so no day stays open."""
    feed, out = scratch_path(spark, "feed"), scratch_path(spark, "trending")
    dated = fixtures.posts(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "text")
    streams.closed_feed(dated).write.parquet(feed)
    arriving = spark.readStream.schema("ts timestamp, text string").parquet(feed)
    started = streams.start_trending(
        arriving, scratch_path(spark, "stream-state"), out, available_now=True
    )
    started.awaitTermination()
    closed = spark.read.schema(
        "window_start timestamp, window_end timestamp, hashtag string, n bigint"
    ).parquet(out)
    return closed.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "hashtag", "n"
    )


# Formats


@query
def key_metrics_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headline numbers as shown to a reader."""
    numbers = QUERIES["key_metrics"](spark, sf_dir)
    return numbers.select(
        metrics.thousands(F.col("total_posts")).alias("total_posts"),
        metrics.thousands(F.col("unique_users")).alias("unique_users"),
        metrics.thousands(F.col("total_engagement")).alias("total_engagement"),
        metrics.percent_text(F.col("positive_percent")).alias("positive_percent"),
    )
