"""Hashtag streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterscope.functions.text import SPACE, extract_hashtags

BATCH_INTERVAL = "5 seconds"


def read_lines(spark: SparkSession, path: str | None = None, source: str = "text", **options) -> DataFrame:
    """Stream of ``value`` lines: a folder of text files, or any line source Spark has."""
    reader = spark.readStream.format(source).options(**options)
    lines = reader.load(path) if path else reader.load()
    return lines.select(F.col("value").cast("string").alias("value"))


def hashtag_words(lines: DataFrame) -> DataFrame:
    """Lower-case words that start with '#', one per row."""
    # A '#' with nothing or white space before it, and what follows up to white space.
    pattern = rf"(#(?<![^{SPACE}]#)[^{SPACE}]*)"
    words = F.regexp_extract_all(F.lower("value"), F.lit(pattern), F.lit(1))
    return lines.select(F.explode_outer(words).alias("hashtag")).filter(
        F.col("hashtag").isNotNull()
    )


def parquet_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer: each batch has its own folder, so a batch that is run again replaces itself.

    A batch without hashtags writes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        found = batch.persist()
        if not found.isEmpty():
            found.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
        found.unpersist()

    return write


def start_hashtags(
    lines: DataFrame,
    checkpoint: str,
    write_batch: Callable[[DataFrame, int], None],
    available_now: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch's hashtags to ``write_batch``."""
    writer = (
        hashtag_words(lines)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=BATCH_INTERVAL).start()


def found_messages(hashtags: DataFrame) -> DataFrame:
    return hashtags.select(F.concat(F.lit("Found hashtag: "), "hashtag").alias("message"))


def trending(posts: DataFrame, window: str = "1 day", lateness: str = "10 minutes") -> DataFrame:
    """Hashtag counts per time window of a post stream; rows later than ``lateness`` are dropped.

    Windows are aligned to UTC; state is one count per open window and hashtag.
    """
    tags = (
        posts.select(F.col("ts").cast("timestamp").alias("ts"), "text")
        .withWatermark("ts", lateness)
        .select("ts", F.explode_outer(extract_hashtags(F.col("text"))).alias("hashtag"))
        .filter(F.col("hashtag").isNotNull())
    )
    counted = tags.groupBy(F.window("ts", window), "hashtag").agg(F.count("*").alias("n"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "hashtag",
        "n",
    )


def closed_feed(posts: DataFrame, after: str = "2 days") -> DataFrame:
    """A finite feed (ts, text) and a row without a text that comes ``after`` its last one: a
    stream of it closes all windows of the feed, given ``after`` exceeds window and lateness."""
    end = posts.agg((F.max("ts") + F.expr(f"INTERVAL {after}")).alias("ts"))
    return posts.unionByName(end.withColumn("text", F.lit(None).cast("string")))


def start_trending(
    posts: DataFrame, checkpoint: str, path: str, available_now: bool = False, **options
) -> StreamingQuery:
    """Append each closed window's counts to Parquet."""
    writer = (
        trending(posts, **options)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=BATCH_INTERVAL).start()
