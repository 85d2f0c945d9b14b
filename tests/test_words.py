"""Words by Arrow batches: as Spark's own expressions find them, in one pass over the texts."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from chatterscope.functions import sentiment, text, words
from chatterscope.operators import dictionaries, trends
from chatterscope.plans import features

ODD = [
    "See http://a.b/c?d, www.x  @ann@bob: don't \x1cStop\x85NOW　\xa0x_1y", "ΟΔΟΣ ΟΔΟΣΑ İstanbul ǅ ﬁ",
    "@ @é1½ a@b ½ Ⅷ 日本 ٣ 🙂é🙂 é", "", "  ", "\t\n", None, "http", "www", "a�b", "RT @x: y",
]


def expressions(c, ascii_only):
    return F.filter(F.split(text.clean_text(c, ascii_only), " "), lambda w: w != "")


def test_clean_words_as_by_expressions(spark):
    dice = random.Random(5)
    mixed = ["".join(dice.choices("aZé_9 @#.ΣσñÑ日½\t\xa0\x85hw", k=dice.randint(0, 40))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in ODD + mixed], "text string")
    for ascii_only in (False, True):
        rows = df.select("text", text.clean_words(F.col("text"), ascii_only), expressions(F.col("text"), ascii_only))
        for t, got, want in rows.collect():
            assert got == want, (ascii_only, t)


def test_every_character_as_by_expressions(spark):
    cp = F.col("id")
    df = spark.range(1 << 16).filter(~cp.between(0xD800, 0xDFFF)).repartition(4)
    one = F.decode(F.encode(F.from_json(F.concat(F.lit('{"c":"\\u'), F.lpad(F.lower(F.hex(cp)), 4, "0"), F.lit('"}')), "c string")["c"], "utf-8"), "utf-8")
    df = df.select(one.alias("c"), F.concat(F.lit("A"), one, F.lit("B "), one).alias("text"))
    wrong = df.filter(text.clean_words(F.col("text")) != expressions(F.col("text"), False))
    # Letters that this Java does not know yet.
    assert wrong.filter(~F.col("c").rlike(r"\p{Cn}")).collect() == []


def test_texts_are_cleaned_in_one_pass_without_lambdas_over_words(spark, capsys):
    df = spark.createDataFrame([(1, "not good, great mice")], "post_id long, text string")
    for found in (
        features.with_sentiment(df).select("sentiment_score"),
        features.with_tokens(df).select("tokens"),
        df.select(text.without(text.clean_words(F.col("text")), ["not"])),
    ):
        found.explain()
        plan = capsys.readouterr().out
        assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan and "split(" not in plan


def test_counts_leave_the_tasks_added_up(spark):
    rows = [("a b a",)] * 500 + [("b",), (None,), ("",)]
    df = spark.createDataFrame(rows, "text string").coalesce(1)
    read = df.mapInArrow(words.by_batch(words.clean, words.statistics), "word string, n long, df long")
    assert sorted(map(tuple, read.collect())) == [("a", 1000, 500), ("b", 501, 501)]
    assert {tuple(r) for r in trends.term_statistics(df.withColumn("text", F.concat("text", F.lit(" cc"))), []).collect()} >= {("cc", 502, 502)}
    by_clean = df.withColumnRenamed("text", "clean_text")
    assert sorted(map(tuple, dictionaries.vocabulary(by_clean, ["a"]).collect())) == [("b", 501)]


def test_lists_may_be_null_empty_or_sliced():
    lists = pa.array([["x"], None, [], ["not", "a", None, "a"], ["a"]], pa.list_(pa.string())).slice(1)
    assert words.without(lists, ["x"]).to_pylist() == [None, [], ["not", "a", "a"], ["a"]]
    assert words.without(lists, ["a"]).to_pylist() == [None, [], ["not"], []]
    assert words.replaced(lists, {"a": "b"}).to_pylist() == [None, [], ["not", "b", None, "b"], ["b"]]
    assert words.polarity(lists, {"a": 1.0}, ["not"], -0.5).to_pylist() == [0.0, 0.0, 0.25, 1.0]
    assert words.polarity(lists, {}, [], -0.5).to_pylist() == [0.0] * 4
    assert words.clean(pa.array([], pa.string())).to_pylist() == []


def test_scorer_gets_bounded_parts(spark):
    df = spark.range(64).select(F.repeat(F.lit("x"), 1_000_000).alias("text")).coalesce(1)
    scored = sentiment.score_text(df, lambda part: part.str.len() * 0.0 + len(part))
    assert scored.agg(F.max("score")).first()[0] <= words.SLICE_BYTES // 1_000_000


def test_texts_are_cleaned_together():
    import sys

    column, calls = pa.array([f"Note {i}, not bad @ann É ñ" for i in range(500)]), []
    sys.setprofile(lambda frame, event, f: calls.append(f.__name__) if event == "c_call" else None)
    try:
        found = words.clean(column)
    finally:
        sys.setprofile(None)
    assert calls.count("translate") < 10 and calls.count("split") < 10
    assert found.to_pylist() == [["note", "not", "bad", "é", "ñ"]] * 500


def test_texts_of_other_alphabets_and_marks_are_cleaned_alike(monkeypatch):
    texts = ["a\0b @x\0y", "ΟΔΟΣ ΟΔΟΣΑ 🙂İ̇x　日本", None, "\0", "ẞ　Ж٣ж ǅ'", "Ñ\x85µ\xa0×"]
    want = [["ab", "y"], ["οδος", "οδοσα", "i̇x", "日本"], [], [], ["ß", "жж", "ǆ"], ["ñ", "µ"]]
    for few in (0, words.FEW):
        monkeypatch.setattr(words, "FEW", few)
        assert words.clean(pa.array(texts)).to_pylist() == want
        assert [words.clean(pa.array([t])).to_pylist()[0] for t in texts] == want
    assert words.clean(pa.array(texts), True).to_pylist()[0] == ["ab", "y"]


def test_rollup_extracts_hashtags_once(spark, capsys):
    from chatterscope.operators import rollups

    posts = spark.createDataFrame([(1, "great #NYC #AI", "ann", None)], "post_id long, text string, username string, ts timestamp")
    rollups.daily_rollup(posts).explain()
    assert capsys.readouterr().out.count("regexp_extract_all(") == 1
