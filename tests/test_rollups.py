"""The shared roll-up, its refresh by day, heavy hitters and the tag index."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chatterscope.operators import heavy, rollups, trends
from chatterscope.operators.tables import search_posts
from chatterscope.sources import indexed
from chatterscope.sources.posts import rewrite_days, write_posts

POSTS = "post_id long, ts timestamp, text string, username string, lang string, likes string, retweets string, replies string"


def day(n, hour=12):
    return datetime.datetime(2024, 1, n, hour)


ROWS = [
    (1, day(1), "good #AI #NYC", "ann", "en", "1", "2", "3"),
    (2, day(1), "terrible #ai", "bob", "en", "N/A", None, "1"),
    (3, day(2), "#NYC #NYC great", "ann", "en", "5", "0", "0"),
    (4, day(2), None, None, "en", "1", "1", "1"),
    (5, None, "good #AI", "cy", "de", "1", "1", "1"),
    (6, day(3), "plain", "bob", "en", "0", "0", "0"),
    (6, day(3), "plain", "bob", "en", "0", "0", "0"),
]


def shown(rows):
    return sorted(map(repr, rows))


def files(path):
    """When each file below ``path`` was written, by day and name."""
    return {f"{f.parent.name}/{f.name}": f.stat().st_mtime_ns for f in Path(path).rglob("day=*/*.parquet")}


@pytest.fixture
def posts(spark):
    return spark.createDataFrame(ROWS, POSTS)


def test_charts_of_a_small_feed(spark, posts, tmp_path):
    rollups.write_rollup(posts, f"{tmp_path}/r")
    got = {}
    for r in rollups.chart_rows(rollups.read_rollup(spark, f"{tmp_path}/r")).collect():
        got.setdefault(r["chart"], []).append(tuple(r)[1:])
    assert {x[1]: x[3] for x in got["top_hashtags"]} == {"AI": 2, "NYC": 3, "ai": 1}
    assert {x[1]: x[3] for x in got["key_metrics"]} == {
        "total_posts": 7, "unique_users": 3, "total_engagement": 18, "positive_percent": 42,
    }
    assert sorted((x[0], x[3], x[4]) for x in got["user_growth"]) == [("2024-01-01", 2, 2.0)]
    assert {x[1]: x[3] for x in got["most_active_users"]} == {"ann": 2, "bob": 3, "cy": 1}
    assert sum(x[3] for x in got["sentiment_distribution"]) == 7
    assert all(x[0] for x in got["sentiment_trends"])


def test_refresh_equals_a_full_run_and_writes_its_days_alone(spark, posts, tmp_path):
    kept, path = f"{tmp_path}/p", f"{tmp_path}/r"
    write_posts(posts.filter("post_id <> 3"), kept)
    rollups.write_rollup(spark.read.parquet(kept), path)
    before = files(path)
    rewrite_days(posts.filter(F.to_date("ts") == "2024-01-02"), kept)
    rollups.refresh_rollup(spark, kept, path, [datetime.date(2024, 1, 2)])
    rollups.write_rollup(posts, f"{tmp_path}/full")
    got, want = (
        shown(rollups.chart_rows(rollups.read_rollup(spark, p)).collect()) for p in (path, f"{tmp_path}/full")
    )
    assert got == want
    after = files(path)
    gone = set(before) - set(after)
    assert gone and all(after[n] == before[n] for n in set(before) & set(after))
    assert {name.split("/")[0] for name in set(after) - set(before)} == {"day=2024-01-02"}


def test_a_day_that_lost_its_posts_and_posts_without_time(spark, posts, tmp_path):
    kept, path = f"{tmp_path}/p", f"{tmp_path}/r"
    write_posts(posts.filter("post_id not in (3, 4, 5)"), kept)
    rollups.write_rollup(posts, path)
    rollups.refresh_rollup(spark, kept, path, [datetime.date(2024, 1, 2), None])
    rollups.write_rollup(spark.read.parquet(kept), f"{tmp_path}/full")
    got, want = (
        shown(rollups.chart_rows(rollups.read_rollup(spark, p)).collect()) for p in (path, f"{tmp_path}/full")
    )
    assert got == want


def test_empty_feed(spark, posts, tmp_path):
    rollups.write_rollup(posts.limit(0), f"{tmp_path}/r")
    rows = rollups.chart_rows(rollups.read_rollup(spark, f"{tmp_path}/r")).collect()
    assert {(r["item"], r["n"]) for r in rows} == {(m, 0) for m in rollups.METRIC_NAMES}


@pytest.mark.parametrize("tracked", [16, 64, 4096])
def test_heavy_words_are_the_most_frequent(spark, tracked):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    texts = [" ".join(w for j, w in enumerate(words) if i % (j + 1) == 0) for i in range(1, 300)]
    feed = spark.createDataFrame([(t,) for t in [*texts, None, "the and"]], "text string").repartition(5)
    for k in (5, 40):
        want = trends.word_frequencies(feed, k).collect()
        assert heavy.word_frequencies_heavy(feed, k, tracked=tracked).collect() == want


def test_only_summaries_are_shuffled(spark):
    feed = spark.createDataFrame([("one two two three",)], "text string")
    words = heavy.clean_words(feed, [])
    found, total = heavy.summarised(words, 64)
    assert sorted(found) == ["one", "three", "two"] and total == 4
    assert heavy.summarised(words.limit(0), 64) == ([], 0)


def test_search_opens_only_files_with_a_tag(spark, tmp_path):
    rows = [(i, day(1 + i % 20), f"text {i} " + ("#Python" if i % 20 == 7 else "#other"), "u", "en", "1", "1", "1") for i in range(200)]
    rows += [(900, None, "#python again", "u", "en", "1", "1", "1"), (901, day(8), "RT @u #python", "u", "en", "1", "1", "1")]
    feed = spark.createDataFrame(rows, POSTS)
    kept, index = f"{tmp_path}/p", f"{tmp_path}/i"
    indexed.write_indexed(feed, kept, index)
    got = indexed.search_indexed(spark, kept, index, ["PYTHON"])
    want = search_posts(feed, ["python"])
    assert sorted(r["post_id"] for r in got.collect()) == sorted(r["post_id"] for r in want.collect())
    opened, every = got.inputFiles(), spark.read.parquet(kept).inputFiles()
    assert 0 < len(opened) <= 3 < 20 <= len(every)
    assert indexed.search_indexed(spark, kept, index, ["nowhere"]).count() == 0


def test_candidates_are_counted_by_the_tasks(spark):
    feed = spark.createDataFrame([("One two two three a", 1), ("two é éé", 2), (None, 3)], "text string, id int")
    counted = heavy.counts_of(feed, ["two", "éé", "never"])
    assert {tuple(r) for r in counted.collect()} == {("two", 3), ("éé", 1)}
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert sorted(r["word"] for r in heavy.clean_words(feed, ["one"]).collect()) == ["three", "two", "two", "two", "éé"]
