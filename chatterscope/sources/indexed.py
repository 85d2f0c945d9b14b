"""Posts with an index of their hashtags: a search opens only files that hold one of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.functions.text import extract_hashtags
from chatterscope.operators.tables import search_posts
from chatterscope.schema import SEARCH_HASHTAGS
from chatterscope.sources.posts import write_posts


def write_indexed(posts: DataFrame, path: str, index_path: str) -> None:
    """Write posts by day, and beside them (tag, day, file): which file holds which tag.

    Tags are in lower case. The index is dealt out by tag, so that a search reads few of its
    row groups.
    """
    write_posts(posts, path)
    spark = posts.sparkSession
    tags = spark.read.parquet(path).select(
        F.explode(F.transform(extract_hashtags(F.col("text")), F.lower)).alias("tag"),
        "day",
        F.col("_metadata.file_path").alias("file"),
    )
    found = tags.distinct().repartitionByRange("tag").sortWithinPartitions("tag", "day", "file")
    found.write.parquet(index_path)


def files_with(spark: SparkSession, index_path: str, hashtags: Sequence[str]) -> list[str]:
    """The files that hold one of the hashtags; as many as the table has at most."""
    wanted = [h.lower() for h in hashtags]
    index = spark.read.parquet(index_path)
    found = index.filter(F.col("tag").isin(wanted)).select("file").distinct().collect()
    return sorted(r["file"] for r in found)


def search_indexed(
    spark: SparkSession,
    path: str,
    index_path: str,
    hashtags: Sequence[str] = SEARCH_HASHTAGS,
    lang: str = "en",
    k: int | None = None,
) -> DataFrame:
    """``tables.search_posts`` over the files that can hold a hit alone."""
    files = files_with(spark, index_path, hashtags)
    whole = spark.read.parquet(path)
    if not files:
        return search_posts(whole.limit(0), hashtags, lang, k)
    some = spark.read.schema(whole.schema).option("basePath", path).parquet(*files)
    return search_posts(some, hashtags, lang, k)
