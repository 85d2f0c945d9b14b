"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_RUNS (runs per
query; the median counts), BENCH_QUERIES (comma-separated names), BENCH_MEMORY.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from chatterscope.checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "top_hashtags",
    "clean_text_unicode",
    "tokens",
    "word_frequencies",
    "term_counts",
    "bag_of_words",
    "key_metrics",
    "sentiment_trends",
    "geo_sentiment",
    "city_mentions",
    "location_markers",
    "author_engagement",
    "user_engagement_top15",
    "content_engagement",
    "posts_with_users",
    "merge_dedup",
    "hashtag_trends",
    "user_growth",
    "interaction_edges",
    "interaction_nodes",
    "degree_centrality",
    "connected_components",
    "community_summary",
    "communities",
    "stream_hashtags",
    "stream_trending",
    "csv_roundtrip",
    "chart_rollup",
    "word_frequencies_heavy",
    "unique_users_by_span",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed(spark, "top_hashtags", sf_dir)
    seconds = {}
    for name in names:
        seconds[name] = round(
            statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3
        )
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
