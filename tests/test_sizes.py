"""What moves and what is written stays small beside the texts, and nothing is lost by it."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chatterscope.checks import fixtures
from chatterscope.functions import text
from chatterscope.operators import dictionaries, tables, trends
from chatterscope.plans import features, joins
from chatterscope.sources import posts as sources

POST = "post_id long, text string, lang string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def multiset(df):
    return sorted(map(str, df.collect()))


def test_words_are_those_of_the_clean_text(spark):
    texts = ["  A\t\xa0b　c @x d", "", None, "don't  STOP\n\nnow", "İx 1\x85é", " . "]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for ascii_only in (False, True):
        cleaned = text.clean_tokens(text.clean_text(F.col("text"), ascii_only))
        rows = df.select(text.clean_words(F.col("text"), ascii_only).alias("a"), cleaned.alias("b")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows]


@pytest.mark.parametrize("sent", [joins.SENT_ROWS, 1, 0])
def test_merged_rows_are_those_of_the_union(spark, monkeypatch, sent):
    monkeypatch.setattr(joins, "SENT_ROWS", sent)
    monkeypatch.setattr(tables, "SENT_ROWS", sent)
    a = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, None, "x"), (None, None, None)], POST)
    b = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", "en"), (3, "y", "en"), (None, None, None)], POST)
    c = spark.createDataFrame([(3, "y"), (4, "z"), (5, "v"), (5, "v")], "post_id long, text string")
    want = multiset(tables.union_posts(a, b, c).distinct())
    assert multiset(tables.merge_posts(a, b, c)) == want
    assert multiset(tables.merge_posts(b)) == multiset(b.distinct())
    total = tables.union_posts(a, b, c)
    assert tuple(tables.dedup_stats(total).first()) == (13, 13 - len(want), len(want))


def test_nested_rows_are_merged_whole(spark):
    a = spark.createDataFrame([(1, [None, "a"]), (2, ["a", None]), (1, [None, "a"])], "id long, t array<string>")
    assert tables.merge_posts(a).count() == 2 and tables.dedup_stats(a).first()["distinct_rows"] == 2


def test_rows_known_elsewhere_are_dropped_without_moving_texts(spark):
    a = spark.createDataFrame([(i, f"t{i}", "en") for i in range(50)], POST)
    assert "Exchange hashpartitioning(text" not in plan_of(tables.merge_posts(a, a.filter("post_id > 9")))
    assert "hashpartitioning(text" not in plan_of(tables.dedup_stats(a))


def test_token_arrays_that_are_there_once_stay(spark):
    df = spark.createDataFrame([("a b",), ("a b",), ("c",), (None,), (None,), ("",)], "text string")
    got = {(None if r["tokens"] is None else tuple(r["tokens"])): r["n"] for r in trends.token_array_counts(df).collect()}
    assert got == {("a", "b"): 2, ("c",): 1, None: 2, ("",): 1}
    single = spark.createDataFrame([("a",), ("b",)], "text string")
    assert "hashpartitioning(text" not in plan_of(trends.token_array_counts(single))


def test_csv_files_have_bounded_rows(spark, tmp_path):
    df = spark.range(25, numPartitions=1).select(F.col("id").alias("post_id"), F.lit("a\nb").alias("text"))
    sources.write_csv_posts(df, str(tmp_path / "csv"), rows=10)
    assert len(list(Path(tmp_path / "csv").glob("*.csv"))) == 3
    assert sources.load_posts(spark, str(tmp_path / "csv"), "csv").filter("text = 'a\nb'").count() == 25


def test_pages_are_written_compressed(spark, tmp_path):
    pages = spark.createDataFrame([('{"data": []}',)], "value string")
    sources.write_payload(pages, str(tmp_path / "pages"))
    assert list(Path(tmp_path / "pages").glob("*.gz"))
    assert sources.load_posts(spark, str(tmp_path / "pages"), "payload").isEmpty()


def test_derived_columns_do_not_move(spark, tmp_path):
    df = spark.createDataFrame([(1, "good day", "2024-01-01"), (2, "bad", "2024-01-02")], "post_id long, text string, ts string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    moved = []

    def derive(by_day):
        moved.extend(by_day.columns)
        return features.enrich(by_day)

    sources.write_posts(df, str(tmp_path / "days"), derive=derive)
    back = sources.load_posts(spark, str(tmp_path / "days"))
    assert moved == ["post_id", "text", "ts", "day"]
    assert multiset(back.select("post_id", "clean_text", "sentiment", "day")) == multiset(
        features.enrich(df).select("post_id", "clean_text", "sentiment", F.to_date("ts").alias("day"))
    )


def test_vocabulary_of_learned_lemmas_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    words = spark.createDataFrame([("cats", 2), ("cat", 1)], "word string, n long")
    lemmas = dictionaries.learn_lemmas(words.mapInArrow(count, words.schema))
    assert {(r["form"], r["lemma"]) for r in lemmas.collect()} >= {("cats", "cat")}
    assert seen.value == 2


def test_joined_lookups_of_kept_dictionaries_are_alike(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (1, ["a", "b", "a"])], "id long, tokens array<string>")
    entries = spark.createDataFrame([("a", "z"), ("a", "y"), (None, "n")], "form string, lemma string")

    def looked_up():
        found = joins.lookup_tokens(df, "tokens", entries, "form", "lemma", inline_limit=0)
        value = F.transform("tokens", lambda t: F.coalesce(found.value(t), found.token(t)))
        return found.df.select("id", value.alias("v"))

    sent = looked_up()
    assert "hashpartitioning(token" not in plan_of(sent)
    got = multiset(sent)
    monkeypatch.setattr(joins, "SENT_ROWS", 0)
    assert multiset(looked_up()) == got


def test_large_dictionaries_go_to_the_tasks(spark, monkeypatch):
    # Beyond the constants of a plan words are still looked up where they lie, and alike in the join.
    df = spark.createDataFrame([(1, "a not b c"), (None, "a a"), (1, None), (2, "c"), (1, "a not b c")], "post_id long, text string")
    lexicon = spark.range(30_000).selectExpr("concat('w', id) AS word", "0.5D AS polarity").unionAll(
        spark.createDataFrame([("a", 0.5), ("b", -1.0), ("a", 0.25), (None, 1.0), ("c", None)], "word string, polarity double")
    )
    tokens = df.select("post_id", F.split("text", " ").alias("tokens"))
    lemmas = lexicon.select(F.col("word").alias("form"), F.concat("word", F.lit("s")).alias("lemma"))

    def both():
        return features.with_sentiment(df, lexicon).select("post_id", "text", "sentiment_score"), features.lemmatize(tokens, lemmas)

    here = both()
    assert not any("Exchange" in plan_of(x) for x in here)
    assert {r["text"]: r["sentiment_score"] for r in here[0].collect()} == {"a not b c": 0.375, "a a": 0.25, None: 0.0, "c": 0.0}
    got = [multiset(x) for x in here]
    monkeypatch.setattr(joins, "ENTRY_ROWS", 0)
    assert [multiset(x) for x in both()] == got
    pairs = joins.lookup_tokens(tokens, "tokens", lemmas, "form", "lemma")
    monkeypatch.undo()
    sent = joins.lookup_tokens(tokens, "tokens", lemmas, "form", "lemma")
    assert multiset(sent.df) == multiset(pairs.df)


def test_large_days_are_written_where_they_are(spark, monkeypatch, tmp_path):
    df = spark.range(400, numPartitions=2).selectExpr("id AS post_id", "timestamp_seconds(id % 2 * 86400) AS ts", "to_date(timestamp_seconds(id % 2 * 86400)) AS day")
    assert "REBALANCE" in plan_of(sources.placed(df))
    monkeypatch.setattr(sources, "FILE_ROWS", 50)
    assert "Exchange" not in plan_of(sources.placed(df))
    sources.write_posts(df.drop("day"), str(tmp_path / "days"))
    back = sources.load_posts(spark, str(tmp_path / "days"))
    assert multiset(back.select("post_id", "ts", "day")) == multiset(df)


def test_lines_and_csv_are_compressed_and_read_back(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sources, "LINE_ROWS", 10)
    df = spark.range(25, numPartitions=1).selectExpr("id AS post_id", "concat('a\n#t', id) AS text")
    sources.write_lines(df, str(tmp_path / "lines"))
    assert len(list(Path(tmp_path / "lines").glob("*.txt.gz"))) == 3
    assert spark.read.text(str(tmp_path / "lines")).filter("value LIKE 'a #t%'").count() == 25
    sources.write_csv_posts(df, str(tmp_path / "csv"), rows=10, compression="gzip")
    assert len(list(Path(tmp_path / "csv").glob("*.csv.gz"))) == 3
    back = sources.load_posts(spark, str(tmp_path / "csv"), "csv")
    assert multiset(back.select("post_id", "text")) == multiset(df)


def test_texts_of_pages_move_once(spark):
    posts = spark.createDataFrame(
        [(1, "a", None, 10, "5", "1", "1", "1", "en"), (2, "b", None, 10, "x", "1", "1", "1", "en"), (150, "c", None, 11, "1", "1", "1", None, "de"), (3, None, None, None, "1", "1", "1", "1", None)],
        "post_id long, text string, ts timestamp, author_id long, likes string, retweets string, replies string, quotes string, lang string",
    )
    user = "id long, username string, followers long, following long, total_posts long"
    users = spark.createDataFrame([(10, "u", 1, 2, 3), (12, "w", 1, 2, 3)], user)

    def read(pages):
        found = pages.selectExpr("from_json(value, 'data array<struct<id: long, text: string>>, includes struct<users: array<struct<id: long, username: string>>>') AS p")
        return sorted((sorted((d["id"], d["text"]) for d in r["p"]["data"]), sorted(u["username"] for u in r["p"]["includes"]["users"])) for r in found.collect())

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pages = fixtures.payload_pages(posts, users)
        # The one join is of authors, each once for a page, and profiles.
        plan = pages._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") == 1
        assert "Aggregate [page" in plan[plan.index("Join") :]
        assert read(pages) == [([(1, "a"), (2, "b"), (3, None)], ["u"]), ([(150, "c")], [])]
        twice = users.unionAll(spark.createDataFrame([(10, "v", 1, 2, 3)], user))
        assert read(fixtures.payload_pages(posts, twice))[0] == ([(1, "a"), (1, "a"), (2, "b"), (2, "b"), (3, None)], ["u", "v"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
