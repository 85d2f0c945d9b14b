import pytest
from pyspark.sql import functions as F

from chatterscope.llm import language

SCHEMA = "doc_id long, text string, lang string, score double, _text string"
ENGLISH = "the cat sat on the mat and the dog ran to the house with water and bread"
GERMAN = "der Hund lief über die Straße und die Katze schlief im Haus mit Wasser und Brot"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.5, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(frame(spark, [(ENGLISH, "en"), (GERMAN, "de")] * 4 + [(None, "en"), ("x", None)]))


def test_known_words_then_shorter_and_shorter_grams(spark, model):
    assert model.languages == ["de", "en"]
    rows = ["the dog", "DIE STRASSE", "Straßen", "watery", None, "", "12 !? 34", "日本", "the " * 50_000]
    got = language.predict(frame(spark, [(t, None) for t in rows]), model, keep=("doc_id", "_text"))
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert [by_id[i][0] for i in range(9)] == ["en", "de", "de", "en", "und", "und", "und", "de", "en"]
    assert all(0 <= s <= 1 for _, s in by_id.values()) and by_id[4][1] == 0.0
    assert by_id[7][1] == pytest.approx(0.5)


def test_unseen_word_takes_its_longest_known_grams(model):
    ids = [model.grams[g] for g in ("wate", "ater") if g in model.grams]
    five = [model.grams[g] for g in (" wate", "water") if g in model.grams]
    assert (model.unseen("waterx") == model.gram_scores[five].mean(0)).all() and ids
    assert (model.unseen("日") == 0).all()


def test_nothing_to_learn_and_no_rows(spark, model):
    assert language.fit(frame(spark, [])) is None
    assert language.fit(frame(spark, [(None, "en"), ("a", None)])) is None
    got = language.predict(frame(spark, [("a", "en")]), None).collect()
    assert [tuple(r) for r in got] == [(0, "und", 0.0)]
    assert language.predict(frame(spark, []), model).isEmpty()


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = language.fold_of(F.col("doc_id"), 4)
    fitted = language.fit(documents.filter(fold != 2))
    held = documents.filter(fold == 2)
    got = language.predict(held, fitted, keep=("doc_id", "lang"))
    assert got.filter("lang = lang_pred").count() >= 0.95 * held.count()


def brute_model(rows, vocabulary, grams):
    """(languages, word log shares, n-gram log shares by length) in plain dictionaries."""
    import math
    from collections import Counter, defaultdict

    counts = defaultdict(Counter)
    for text, lang in rows:
        for word in brute_words(text):
            counts[word][lang] += 1
    kept = sorted(counts, key=lambda w: (-counts[w].total(), w.encode()))[:vocabulary]
    languages = sorted({lang for w in kept for lang in counts[w]})
    pieces = defaultdict(Counter)
    for word in kept:
        for n in range(1, language.LONGEST + 1):
            source = f" {word} " if n > 1 else word
            for j in range(len(source) - n + 1):
                pieces[source[j : j + n]].update(counts[word])
    top = sorted(pieces, key=lambda g: (-pieces[g].total(), g))[:grams]

    def shares(names, by):
        total = {lang: sum(by[x][lang] for x in names) for lang in languages}
        return {
            x: [math.log((by[x][lang] + 0.5) / (total[lang] + 0.5 * len(names))) for lang in languages]
            for x in names
        }

    known = {}
    for n in range(1, language.LONGEST + 1):
        known |= shares([g for g in top if len(g) == n], pieces)
    return languages, shares(kept, counts), known


def brute_words(text):
    import re

    return re.findall(r"[a-z\u0080-\U0010ffff]+", (text or "").lower())


def brute_predict(model, text):
    import math

    languages, words, grams = model
    sums = [0.0] * len(languages)
    for word in brute_words(text):
        row = words.get(word)
        for n in range(language.LONGEST, 0, -1):
            if row is not None:
                break
            source = f" {word} " if n > 1 else word
            found = [grams[source[j : j + n]] for j in range(len(source) - n + 1) if source[j : j + n] in grams]
            row = [sum(c) / len(found) for c in zip(*found)] if found else None
        sums = [a + b for a, b in zip(sums, row or [0.0] * len(languages))]
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    best = max(range(len(languages)), key=lambda i: sums[i])
    return languages[best], 1 / sum(math.exp(s - sums[best]) for s in sums)


@pytest.mark.parametrize("vocabulary, grams", [(100_000, 100_000), (400, 900), (40, 60)])
def test_same_as_brute_force(spark, vocabulary, grams):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r["text"], r["lang"]) for r in documents.collect()]
    half = documents.filter("doc_id % 2 = 0")
    model = language.fit(half, vocabulary=vocabulary, grams=grams)
    brute = brute_model([(r["text"], r["lang"]) for r in half.collect()], vocabulary, grams)
    odd = [("Straßen über é🎉 zzzq", None), ("", None), (None, None), ("日本 x", None)]
    table = frame(spark, rows + odd)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(table, model).collect()}
    for i, (text, _) in enumerate(rows + odd):
        name, score = brute_predict(brute, text)
        assert got[i][0] == name and got[i][1] == pytest.approx(score, abs=1e-6)
