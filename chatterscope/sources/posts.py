"""Readers and writers of the post table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterscope.functions.text import is_blank, one_line
from chatterscope.schema import CSV_HEADER, MISSING, POST_SCHEMA

QUOTING = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}

# Rows of one CSV file: a multi-line file is read by one task, so it must not grow with the table.
CSV_ROWS = 4_000

# Lines of one compressed text file.
LINE_ROWS = 50_000

# Rows of one file that make it worth while to write a day's rows where they are.
FILE_ROWS = 4_000

# One API page: posts, and the users they are by.
PAYLOAD_SCHEMA = """
    data array<struct<
        id: bigint, text: string, created_at: timestamp, author_id: bigint, lang: string,
        public_metrics: struct<
            like_count: int, retweet_count: int, reply_count: int, quote_count: int>>>,
    includes struct<users: array<struct<
        id: bigint, username: string,
        public_metrics: struct<
            followers_count: bigint, following_count: bigint, tweet_count: bigint>>>>
"""


def conform(df: DataFrame, keep_extra: bool = False) -> DataFrame:
    """Rename source columns to post columns and cast them; columns the source lacks stay out."""
    present = {c.lower(): c for c in df.columns}
    picked, used = [], set()
    for field in POST_SCHEMA.fields:
        for name in (field.name, CSV_HEADER[field.name].lower()):
            if name in present:
                source = F.col(f"`{present[name]}`")
                picked.append(source.try_cast(field.dataType).alias(field.name))
                used.add(present[name])
                break
    if keep_extra:
        picked += [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*picked)


def read_csv_posts(
    spark: SparkSession, path: str, multi_line: bool = True, keep_extra: bool = False
) -> DataFrame:
    """Read posts from CSV with a header; quotes inside a text are doubled.

    Columns are found by header name and cast without an inference pass. A multi-line
    file is read by one task, so keep files moderate, as ``write_csv_posts`` does, or convert
    them with ``write_posts`` once.
    """
    raw = spark.read.options(**QUOTING, multiLine=multi_line).csv(path)
    return conform(raw, keep_extra)


def write_csv_posts(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    rows: int = CSV_ROWS,
    compression: str = "none",
) -> None:
    """Write CSV with a header and without an index; arrays and structs as JSON.

    A file has ``rows`` rows at most, a task goes on with the next one. Readers know a
    ``compression`` such as gzip by the names of the files.
    """
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    flat.write.mode(mode).options(
        **QUOTING,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=rows,
        compression=compression,
    ).csv(path)


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """Read API pages (one JSON document per line) and flatten them to posts."""
    return flatten_payload(spark.read.schema(PAYLOAD_SCHEMA).json(path))


def _text_or_missing(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(MISSING))


def flatten_payload(pages: DataFrame) -> DataFrame:
    """One row per post of each page, with its author from the users the page includes.

    A page carries its own users, so the author is found inside the row: no shuffle. Of
    users listed twice the last wins.
    """
    posts = pages.select(
        F.explode("data").alias("post"), F.col("includes.users").alias("users")
    )
    author = F.try_element_at(
        F.filter("users", lambda u: u["id"] == F.col("post.author_id")), F.lit(-1)
    )
    return posts.withColumn("author", author).select(
        F.col("post.id").alias("post_id"),
        F.col("post.text").alias("text"),
        F.col("post.created_at").alias("ts"),
        F.col("post.author_id").alias("author_id"),
        F.col("post.public_metrics.like_count").cast("string").alias("likes"),
        F.col("post.public_metrics.retweet_count").cast("string").alias("retweets"),
        F.col("post.public_metrics.reply_count").cast("string").alias("replies"),
        F.col("post.public_metrics.quote_count").cast("string").alias("quotes"),
        _text_or_missing(F.col("author.username")).alias("username"),
        _text_or_missing(F.col("author.public_metrics.followers_count")).alias("followers"),
        _text_or_missing(F.col("author.public_metrics.following_count")).alias("following"),
        _text_or_missing(F.col("author.public_metrics.tweet_count")).alias("total_posts"),
        F.col("post.lang").alias("lang"),
    )


def load_posts(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """Posts from ``csv``, ``payload`` (API pages as JSON), or any Spark file format."""
    if source == "csv":
        return read_csv_posts(spark, path)
    if source == "payload":
        return read_payload(spark, path)
    return spark.read.format(source).load(path)


# Texts are most of a post, and smaller by this codec than by the default one.
CODEC = "zstd"


def placed(by_day: DataFrame) -> DataFrame:
    """Rows of a day meet, Spark splits days that are large and joins small ones; but where each
    task has ``FILE_ROWS`` of a day on an average, its files are large as it is and nothing moves."""
    size = by_day.agg(F.count("*").alias("rows"), F.count_distinct("day").alias("days")).first()
    tasks = int(by_day.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size["rows"] >= FILE_ROWS * tasks * max(size["days"], 1):
        return by_day
    return by_day.hint("rebalance", "day")


def write_posts(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write Parquet by day, so that time filters prune whole folders.

    The number of files follows the size of the days: see ``placed``. ``derive`` adds columns row
    by row; it works behind the shuffle, which then moves the posts alone.
    """
    by_day = placed(df.withColumn("day", F.to_date("ts")))
    if derive is not None:
        by_day = derive(by_day)
    by_day.write.mode(mode).option("compression", CODEC).partitionBy("day").parquet(path)


def rewrite_days(df: DataFrame, path: str) -> None:
    """Replace the days that ``df`` has in posts kept by day; the other days stay as they are."""
    by_day = df.withColumn("day", F.to_date("ts")).hint("rebalance", "day")
    writer = by_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", CODEC).partitionBy("day").parquet(path)


def posts_to_lines(posts: DataFrame) -> DataFrame:
    """One line per post with a text, for line-oriented feeds."""
    return posts.filter(F.col("text").isNotNull()).select(one_line(F.col("text")).alias("value"))


def write_payload(pages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write API pages, one JSON document per line, compressed."""
    pages.write.mode(mode).option("compression", "gzip").text(path)


def write_lines(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``posts_to_lines`` compressed, in files of bounded length: each is read by one task."""
    writer = posts_to_lines(posts).write.mode(mode).option("compression", "gzip")
    writer.option("maxRecordsPerFile", LINE_ROWS).text(path)


def with_text(posts: DataFrame, column: str = "text") -> DataFrame:
    return posts.filter(~is_blank(F.col(column)))


def describe_columns(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def write_charts(charts: dict[str, DataFrame], path: str) -> None:
    """Write each chart table to its own Parquet folder."""
    for name, chart in charts.items():
        chart.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
