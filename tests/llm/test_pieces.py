import itertools

import numpy as np
import pytest

from chatterscope.llm import pieces
from chatterscope.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/piece_bpe_32k.model"
SCHEMA = "doc_id long, text string, ids string, scores int"
TEXTS = ["", " ", "a▁b ▁▁ c", "Hello  world\r\n\tx", "x" * 500 + "=" * 900, "\x00é🎉日本 1² ².", "the theaning, of!"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(PATH)


def every_segmentation(vocabulary, text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    by_text = {t: i for i, t in vocabulary.text.items()}

    def go(at):
        if at == len(text):
            yield 0.0, ()
            return
        one = text[at] in by_text
        for end in range(at + 1, len(text) + 1):
            i = by_text.get(text[at:end])
            if i is not None:
                yield from ((model.get_score(i) + s, (i, *rest)) for s, rest in go(end))
        if not one:
            spelled = vocabulary.spelled(text[at])
            yield from ((vocabulary.lowest + s, (*spelled, *rest)) for s, rest in go(at + 1))

    return sorted(go(0), reverse=True)


@pytest.mark.parametrize("part", ["▁theaning", "▁ciónta", "ñez", "▁A日x", "=======", "▁▁▁a", "\n\n"])
def test_n_best_of_a_part_are_those_of_all(vocabulary, part):
    want = every_segmentation(vocabulary, part)
    found = vocabulary.search(part, 6)
    assert [s for s, _ in found] == [s for s, _ in want[:6]]
    assert set(found) <= set(want) and len(set(found)) == len(found)


@pytest.mark.parametrize("text", ["the ant", "of, a", "inn\nso", "x  y"])
def test_n_best_of_a_text_are_those_of_all(vocabulary, text):
    whole = (" " + text).replace(" ", pieces.BLANK)
    want = every_segmentation(vocabulary, whole)
    ids, scores, edits = vocabulary.encode(text, 5)
    assert scores == [s for s, _ in want[:5]]
    ways = {tuple(ids.tolist())} | {tuple(pieces.apply_edits(ids, e).tolist()) for e in edits}
    assert len(ways) == len(scores) and ways <= {w for _, w in want}


def test_every_segmentation_decodes_to_its_text(vocabulary):
    for text in TEXTS:
        ids, scores, edits = vocabulary.encode(text, 3)
        assert scores == sorted(scores, reverse=True)
        for way in [ids, *(pieces.apply_edits(ids, e) for e in edits)]:
            assert vocabulary.decode(way) == text


def test_parts_are_forgotten_without_effect(monkeypatch):
    vocabulary = pieces.Pieces(PATH)
    words = ["".join(w) for w in itertools.product("aeinorst", repeat=3)]
    want = [vocabulary.encode(w, 2) for w in words]
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    for word, (ids, scores, edits) in zip(words, want, strict=True):
        got = vocabulary.encode(word, 2)
        assert (got[0] == ids).all() and got[1:] == (scores, edits)


def test_round_trip_of_tables(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate([*TEXTS, None, TEXTS[-1]])]
    df = spark.createDataFrame(rows, SCHEMA)
    encoded = pieces.encode(df, PATH, 3, keep=("doc_id",))
    got = {r["doc_id"]: r["decoded"] for r in pieces.decode(encoded.select("doc_id", "ids"), PATH).collect()}
    assert got == {i: t or "" for i, t, *_ in rows}
    assert pieces.encode(df.limit(0), PATH).isEmpty()
    for row in encoded.collect():
        for edits in row["alternatives"]:
            pieces.apply_edits(np.array(row["ids"]), [(e["first"], e["drop"], e["ids"]) for e in edits])


def test_query_and_pipeline_search_the_three_best(spark, tmp_path):
    import corpus_pipeline
    from chatterscope.llm import queries

    text = "the theaning, of!"
    docs = spark.createDataFrame([(1, text, "en", "x"), (2, None, None, None)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    asked = {r["doc_id"]: r for r in queries.QUERIES["op3_pieces"](spark, str(tmp_path)).collect()}
    done = {r["doc_id"]: r for r in corpus_pipeline.encode_pieces(spark, docs, "").collect()}
    ids, scores, edits = pieces.load(PATH).encode(text, 3)
    for row in (asked[1], done[1]):
        assert (row["n_best"], row["margin"], row["last_margin"]) == (3, scores[0] - scores[1], scores[0] - scores[2])
    assert asked[1]["last_pieces"] == len(pieces.apply_edits(ids, edits[1]))
    assert done[1]["n_edits"] == sum(map(len, edits)) and done[1]["ids"] == ids.tolist()
    assert (done[2]["n_best"], done[2]["margin"], done[2]["n_edits"]) == (1, None, 0)


def test_other_segmentations_of_a_part_are_searched_once(monkeypatch):
    vocabulary = pieces.Pieces(PATH)
    want, asked = vocabulary.encode("theaning theaning of", 3), []
    search = vocabulary.search
    monkeypatch.setattr(vocabulary, "search", lambda part, n: asked.append(part) or search(part, n))
    vocabulary.forget()
    got = [vocabulary.encode("theaning theaning of", 3) for _ in range(2)]
    assert len(asked) == len(set(asked))
    for ids, scores, edits in got:
        assert (ids == want[0]).all() and (scores, edits) == want[1:]


def test_decode_refuses_what_is_no_piece(vocabulary):
    assert vocabulary.decode(np.zeros(0, np.int32)) == ""
    with pytest.raises((KeyError, IndexError)):
        vocabulary.decode(np.array([vocabulary.size], np.int32))
    with pytest.raises(KeyError):
        vocabulary.decode(np.array([0], np.int32))


def test_a_task_leaves_no_remembered_parts(spark):
    df = spark.createDataFrame([(1, "the theaning, of!", "x", 1)], SCHEMA).coalesce(1)
    pieces.encode(df, PATH, 3).collect()

    def left(batches):
        import pyarrow as pa

        known = pieces.load(PATH)
        yield from (pa.RecordBatch.from_pydict({"n": [len(known.memory[0]) + len(known.searched)]}) for _ in batches)

    assert {r["n"] for r in df.mapInArrow(left, "n long").collect()} == {0}
