"""Every registered query against its SQL, and invariants for the rest."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from chatterscope.checks.queries import QUERIES
from chatterscope.functions.metrics import post_engagement

SF_DIR = "/root/testdata/sf0.001"
TABLES = [p.stem for p in Path(SF_DIR).glob("*.parquet")]
@pytest.fixture(scope="module")
def sql(spark):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    texts = contract.oracle_sql()
    return lambda name: con.execute(texts[name])


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, "" if v is None else v) for v in r])


# Compared with a search in plain loops in test_graph.
WITHOUT_SQL = {"community_split"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = sql(name)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    actual = [tuple(row[c] for c in columns) for row in df.collect()]
    assert ordered(actual) == ordered(expected)


def test_every_query_is_covered(spark):
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) - WITHOUT_SQL <= set(contract.oracle_sql())


def test_entry_is_the_flagship(spark):
    rows = {r["hashtag"]: r["n"] for r in contract.entry(spark).collect()}
    assert rows["AI"] == 283 and "Café2025" in rows


def test_topic_queries(spark):
    posts = QUERIES["clean_text_unicode"](spark, SF_DIR).filter("value <> ''").count()
    assert sum(r["n"] for r in QUERIES["topic_distribution"](spark, SF_DIR).collect()) == posts
    shares = {}
    for r in QUERIES["topic_evolution"](spark, SF_DIR).collect():
        shares[r["day"]] = shares.get(r["day"], 0) + r["percentage"]
    assert all(math.isclose(s, 100, abs_tol=1e-4) for s in shares.values())
    keywords = QUERIES["topic_keywords"](spark, SF_DIR).collect()
    assert len(keywords) == 50 and all(r["word"] for r in keywords)
    models = QUERIES["topic_model"](spark, SF_DIR).collect()
    first = {r["topic"]: r["word"] for r in keywords if r["rank"] == 1}
    assert {r["topic"]: r["words"].split(", ")[0] for r in models} == first


def test_sentiment_shares_sum_to_100(spark):
    days = QUERIES["sentiment_trends"](spark, SF_DIR).groupBy("day").sum("percentage").collect()
    assert all(math.isclose(r[1], 100, abs_tol=1e-4) for r in days)


def test_engagement_total_is_null_when_a_metric_is(spark):
    df = spark.createDataFrame(
        [("1", "2", "3", "4"), ("N/A", "2", "3", "4")], ["likes", "retweets", "replies", "quotes"]
    )
    totals = df.select(post_engagement(df.columns).alias("t")).collect()
    assert [r["t"] for r in totals] == [10, None]


def test_topics_of_no_posts(spark):
    from chatterscope.operators import topics

    none = spark.createDataFrame([], "post_id long, ts timestamp, text string")
    assert topics.fit_topics(none) is None
    assert topics.topic_distribution(None, none).isEmpty()
    assert topics.topic_evolution(None, none).isEmpty()
    assert topics.topic_keywords(spark, None).count() == topics.TOPICS
