import pytest

from chatterscope.operators import dictionaries
from chatterscope.plans import features


def posts(spark, texts):
    return spark.createDataFrame([(t, 1) for t in texts], "text string, word int")


def seeds(spark, rows=(("good", 0.7), ("bad", -0.7))):
    return spark.createDataFrame(list(rows), "word string, polarity double")


def learned(spark, texts, **options):
    options = {"window": 2, "least": 1, "stopwords": ["the"], **options}
    rows = dictionaries.learn_lexicon(posts(spark, texts), seeds(spark), **options).collect()
    return {r["word"]: (r["polarity"], r["support"]) for r in rows}


def test_words_near_seeds_take_their_side(spark):
    texts = ["sunny good day", "good sunny", "rainy bad the day", "far x y good", None, "", "alone"]
    got = learned(spark, texts)
    # Positive seeds have 2 + 1 + 2 neighbours, negative ones 3.
    def polarity(good, ill):
        p, q = (good + 0.5) * 4, (ill + 0.5) * 6
        return (p - q) / (p + q)

    assert got == {
        "sunny": (polarity(2, 0), 2), "day": (polarity(1, 1), 2), "rainy": (polarity(0, 1), 1),
        "x": (polarity(1, 0), 1), "y": (polarity(1, 0), 1), "good": (0.7, None), "bad": (-0.7, None),
    }
    assert set(learned(spark, texts, least=2)) == {"sunny", "day", "good", "bad"}


def test_a_negator_turns_a_seed_and_seeds_may_meet(spark):
    got = learned(spark, ["alpha not good beta", "good good gamma"])
    assert got["beta"][0] < 0 < got["gamma"][0]
    assert got["gamma"][1] == 2 and set(got) == {"alpha", "not", "beta", "gamma", "good", "bad"}


def test_no_posts_leave_the_seeds(spark):
    assert learned(spark, []) == {"good": (0.7, None), "bad": (-0.7, None)}


def test_a_learned_lexicon_scores_posts(spark):
    texts = ["good sunny"] * 12 + ["bad rainy"] * 12
    lexicon = dictionaries.learn_lexicon(posts(spark, texts), seeds(spark))
    scored = features.with_sentiment(posts(spark, ["sunny", "rainy", "else"]), lexicon)
    assert [r["sentiment"] for r in scored.collect()] == ["Positive", "Negative", "Neutral"]


def test_seeds_that_do_not_fit_are_refused(spark):
    many = spark.range(30_000).selectExpr("cast(id as string) word", "1.0d polarity")
    with pytest.raises(ValueError, match="seed words"):
        dictionaries.learn_lexicon(posts(spark, ["a"]), many)


def lemmas(spark, words, **options):
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = dictionaries.learn_lemmas(table, **options).collect()
    assert all(r["n"] == words[r["form"]] for r in rows)
    return {r["form"]: r["lemma"] for r in rows}


def test_endings_are_taken_where_the_rest_is_known(spark):
    words = ["boxes", "box", "wolves", "wolf", "cities", "city", "churches", "church", "dogs",
             "dog", "women", "woman", "glass", "glas", "mice", "series", "paris", "as", "a",
             "horses", "horse", "buses", "bus", "blizzes"]
    got = lemmas(spark, {w: i + 1 for i, w in enumerate(words)})
    assert got == {
        "boxes": "box", "wolves": "wolf", "cities": "city", "churches": "church", "dogs": "dog",
        "women": "woman", "mice": "mouse", "horses": "horse", "buses": "bus",
    }


def test_the_first_rule_wins_and_exceptions_go_first(spark):
    words = {"boxes": 3, "box": 1, "boxe": 9, "men": 2, "man": 4}
    assert lemmas(spark, words)["boxes"] == "box"
    # "box" is too rare to be known, so a later ending is taken.
    assert lemmas(spark, words, least=2)["boxes"] == "boxe"
    stated = spark.createDataFrame([("boxes", "boxing"), ("oxen", "ox")], "form string, lemma string")
    assert lemmas(spark, words, exceptions=stated) == {"boxes": "boxing"}
    assert lemmas(spark, {}) == {}


def test_vocabulary_and_lemmas_meet(spark):
    feed = posts(spark, ["Dogs dog, dogs", None, "", "the dog"])
    words = dictionaries.vocabulary(feed, ["the"])
    assert {tuple(r) for r in words.collect()} == {("dogs", 2), ("dog", 2)}
    tokens = features.with_tokens(feed, ["the"], dictionaries.learn_lemmas(words)).collect()
    assert [r["tokens"] for r in tokens] == [["dog", "dog", "dog"], [], [], ["dog"]]
