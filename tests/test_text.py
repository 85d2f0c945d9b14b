import pytest
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.functions import sentiment, text
from chatterscope.functions.dictionary import inline_lookup
from chatterscope.operators import geo, trends
from chatterscope.plans import features


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "post_id long, text string")
    rows = df.orderBy("post_id").select(*columns).collect()
    return [tuple(r) if len(columns) > 1 else r[0] for r in rows]


CLEANED = [
    (None, "", ""),
    ("Check https://t.co/a1 NOW!!", "check now", "check now"),
    ("@bob loves #AI_2025", "loves ai_", "loves ai_"),
    ("awwwful day", "a day", "a day"),
    ("café bar", "cafbar", "café bar"),
    ("don't  stop\n\tnow", "dont stop now", "dont stop now"),
    ("日本 42 😀 ok", "ok", "日本 ok"),
    ("@bobhttp://x y", "y", "y"),
    ("!@bob b   c", "b c", "b c"),
    ("Ⅷ ½ x²", "x", "ⅷ ½ x²"),
    ("  edge \x1c", "edge", "edge"),
    ("a @ b@c", "a b", "a b"),
]


def test_clean_text(spark):
    c = F.col("text")
    got = values(spark, [t for t, _, _ in CLEANED], text.clean_text(c, True), text.clean_text(c))
    assert got == [(a, u) for _, a, u in CLEANED]


def test_names(spark):
    texts = ["RT @ann: #Café2025! see #a_b @bob", "rt @ann", "RT @", None, "x@mail.org ## #"]
    c = F.col("text")
    got = values(
        spark,
        texts,
        text.extract_hashtags(c),
        text.extract_mentions(c),
        text.repost_target(c),
    )
    assert got == [
        (["Café2025", "a_b"], ["ann", "bob"], "ann"),
        ([], ["ann"], None),
        ([], [], None),
        ([], [], None),
        ([], ["mail"], None),
    ]


def test_content_type(spark):
    texts = [None, "see http://a #b", "#b @c", "hi @c", "x" * 141, "x" * 140]
    assert values(spark, texts, text.content_type(F.col("text"))) == [
        "Other", "Links", "Hashtags", "Mentions", "Long Text", "Short Text"
    ]


def test_tokens(spark):
    texts = ["  Two Words ", "a  b", "", None]
    c = F.col("text")
    assert values(spark, texts, text.word_tokens(c)) == [["two", "words"], ["a", "b"], [], []]
    assert values(spark, texts, text.space_tokens(c))[1] == ["a", "", "b"]
    assert values(spark, texts, text.is_blank(c)) == [False, False, True, True]
    assert values(spark, ["a\r\nb\nc"], text.one_line(c)) == ["a b c"]


def test_stopwords_and_lemmas(spark):
    df = spark.createDataFrame(
        [(1, "The mice don't like a_b the cities"), (2, None)], "post_id long, text string"
    )
    rows = features.with_tokens(df).orderBy("post_id").collect()
    assert rows[0]["tokens"] == ["mouse", "dont", "like", "city"]
    assert rows[1]["tokens"] == []
    kept = df.select(text.remove_stopwords(text.clean_text(F.col("text")), schema.stopwords()))
    assert kept.first()[0] == "mice dont like a_b cities"


SCORED = {
    "great": 0.8,
    "not bad": 0.35,
    "no, never good": -0.35,
    "good bad": 0.0,
    "Good day, GREAT": 0.75,
    "goodish": 0.0,
    "": 0.0,
    None: 0.0,
}


def test_sentiment_score_inline_and_joined(spark, monkeypatch):
    # Ids repeat and are null: rows are told apart by what they hold.
    rows = [(None if i % 3 else 1, t) for i, t in enumerate(SCORED)] * 2
    df = spark.createDataFrame(rows, "post_id long, text string")

    def scores():
        found = features.with_sentiment(df).collect()
        assert len(found) == len(rows)
        return {r["text"]: r["sentiment_score"] for r in found}

    inline = scores()
    assert inline == pytest.approx(SCORED)
    from chatterscope.plans import joins

    # A dictionary beyond the bound, every key hot: the join route must agree.
    monkeypatch.setattr(features, "inline_lookup", lambda entries, key, limit: None)
    monkeypatch.setattr(joins, "HOT_FLOOR", 0)
    assert scores() == pytest.approx(SCORED)


def test_lemmatize_joined(spark, monkeypatch):
    from chatterscope.plans import joins

    rows = [(1, ["tags", "x", "tags"]), (1, []), (None, ["x"]), (None, None), (1, ["tags", "x", "tags"])]
    df = spark.createDataFrame(rows, "post_id long, tokens array<string>")
    inline = features.lemmatize(df, schema.lemmas(spark)).collect()
    monkeypatch.setattr(joins, "inline_lookup", lambda entries, key, limit: None)
    joined = features.lemmatize(df, schema.lemmas(spark)).collect()
    assert sorted(map(str, joined)) == sorted(map(str, inline))
    assert [r["tokens"] for r in joined].count(["tag", "x", "tag"]) == 2


def test_labels(spark):
    df = spark.createDataFrame([(None,), (0.1,), (0.11,), (-0.1,), (-0.11,)], "s double")
    got = [r[0] for r in df.select(sentiment.label(F.col("s"))).collect()]
    assert got == ["Neutral", "Neutral", "Positive", "Neutral", "Negative"]


def test_inline_lookup_bound(spark):
    entries = spark.range(1000).select(
        F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v")
    )
    assert inline_lookup(entries, "k", limit=999) is None
    find = inline_lookup(entries, "k")
    rows = spark.range(2000).select("id", find(F.col("id").cast("string"))["v"].alias("v")).collect()
    assert all(r["v"] == (2 * r["id"] if r["id"] < 1000 else None) for r in rows)


def test_place_of_first_matching_tag(spark):
    df = spark.createDataFrame(
        [(1, "#x #Bombay #NYC"), (2, "#nyc"), (3, None)], "post_id long, text string"
    )
    joined = features.with_place(df.unionAll(df), inline_limit=0).distinct().orderBy("post_id")
    rows = features.with_place(df).orderBy("post_id").collect()
    assert joined.collect() == rows
    assert (rows[0]["location_hashtag"], rows[0]["location_name"]) == ("Bombay", "Mumbai")
    assert (rows[0]["latitude"], rows[0]["longitude"]) == (19.076, 72.8777)
    assert rows[1]["location_name"] is None and rows[2]["latitude"] is None


def test_city_mentions(spark, monkeypatch):
    df = spark.createDataFrame(
        [("#NYC \n#NYC #nyc x\n#NYC #London!",), ("#Bombay #Mumbai",), (None,)], "text string"
    )
    expected = {"New York City": 2, "Mumbai": 2}
    assert {r["city"]: r["n"] for r in geo.city_mentions(df).collect()} == expected
    monkeypatch.setattr(geo, "MAX_BROADCAST_PLACES", 3)
    assert {r["city"]: r["n"] for r in geo.city_mentions(df).collect()} == expected
    words = spark.createDataFrame([("x", "X", 0.0, 0.0)], schema.PLACE_SCHEMA)
    plain = spark.createDataFrame([("x y x",)], "text string")
    assert [tuple(r) for r in geo.city_mentions(plain, words).collect()] == [("X", 2)]


def test_bag_of_words_and_terms(spark):
    df = spark.createDataFrame(
        [(1, "b a b"), (2, "a"), (3, ""), (4, None), (5, "bb bb cc"), (6, "cc")],
        "post_id long, text string",
    )
    assert sorted(tuple(r) for r in trends.bag_of_words(df).collect()) == [
        (1, "a", 1), (1, "b", 2), (2, "a", 1), (5, "bb", 2), (5, "cc", 1), (6, "cc", 1)
    ]
    stats = {tuple(r) for r in trends.term_statistics(df, []).collect()}
    assert stats == {("bb", 2, 1), ("cc", 2, 2)}
    assert [tuple(r) for r in trends.term_counts(df, stopwords=[]).collect()] == [("cc", 2)]


def test_hot_text_is_counted_whole(spark):
    posts = spark.range(30_000).select(
        F.col("id").alias("post_id"),
        F.when(F.col("id") % 3 == 0, "#hot").otherwise(F.concat(F.lit("#t"), "id")).alias("text"),
    )
    assert trends.top_hashtags(posts, 1).first()["n"] == 10_000


def test_enrich_has_all_features(spark):
    df = spark.createDataFrame(
        [(1, "RT @ann: not bad #London", "2024-02-04 23:10:00")], "post_id long, text string, ts string"
    ).withColumn("ts", F.to_timestamp("ts"))
    row = features.enrich(df).first()
    assert row["clean_text"] == "rt not bad london" and row["hashtags"] == ["London"]
    assert row["mentions"] == ["ann"] and row["content_type"] == "Hashtags"
    assert row["sentiment"] == "Positive" and row["location_name"] == "London"
    assert (str(row["date"]), row["hour"], row["day_of_week"]) == ("2024-02-04", 23, 1)
