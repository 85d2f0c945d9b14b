"""Kept columns that are called like a result."""

from chatterscope.llm import language, pieces, quality
from chatterscope.llm.queries import TOKENIZERS

SCHEMA = "doc_id long, text string, ids string, score string, lang_pred string, decoded string, lang string"
ROWS = [(1, "the word and the other", "i", "s", "l", "d", "en"), (2, None, "i", "s", "l", "d", None)]


def test_results_take_names_of_their_own(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    path = f"{TOKENIZERS}/piece_bpe_32k.model"
    encoded = pieces.encode(table, path, 1, keep=("doc_id", "ids", "decoded"))
    assert encoded.columns == ["doc_id", "ids", "decoded", "ids_", "scores", "alternatives"]
    decoded = pieces.decode(encoded, path, ids="ids_")
    assert decoded.columns[-1] == "decoded_"
    assert {r["doc_id"]: r["decoded_"] for r in decoded.collect()} == {1: ROWS[0][1], 2: ""}
    for model in (None, language.fit(table)):
        found = language.predict(table, model, keep=("doc_id", "score", "lang_pred"))
        assert found.columns == ["doc_id", "score", "lang_pred", "lang_pred_", "score_"]
        assert {r["score"] for r in found.collect()} == {"s"}
    scored = quality.score(table, None, keep=("doc_id", "score"))
    assert scored.columns == ["doc_id", "score", "score_"] and scored.count() == 2


def test_a_table_of_one_id_is_sampled(spark, monkeypatch):
    many = spark.createDataFrame([(5, f"word{i % 7} the and", "en") for i in range(400)], "doc_id long, text string, lang string")
    model = language.fit(many, sample_docs=20)
    assert model is not None and model.languages == ["en"]
