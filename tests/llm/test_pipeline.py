import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chatterscope.llm import contamination, pieces, quality, secrets, similar
from chatterscope.llm.queries import QUALITY_BAR, TOKENIZERS, quality_model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage read and wrote."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return collections.Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def test_stages_keep_the_columns_of_documents(steps):
    for name in ("quality", "similar", "benchmark", "secrets"):
        before, after = steps[name]
        assert after.columns == before.columns and not after.isEmpty()


def test_rejected_documents_go(spark, steps):
    before, after = steps["quality"]
    model = quality_model(before, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = quality.score(before, model).filter(F.col("score") >= QUALITY_BAR)
    assert {r["doc_id"] for r in scores.collect()} == {r["doc_id"] for r in after.select("doc_id").collect()}


def test_one_of_each_group_stays(steps):
    before, after = steps["similar"]
    rule = similar.Rule(words=5, percent=80)
    sets = {
        r["doc_id"]: set(found.tolist())
        for r in before.collect()
        for _, found in similar.shingle_sets(_column(r["text"]), rule.words)
    }
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            p, q = sets[a], sets[b]
            if p and 100 * len(p & q) >= rule.percent * len(p | q):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {d for d in ids if find(d) == d}


def _column(text):
    import pyarrow as pa

    return pa.array([text])


def test_contaminated_documents_go(spark, steps):
    before, after = steps["benchmark"]
    found = contamination.overlaps(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
    gone = {r["doc_id"] for r in found.collect()}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - gone


def test_secrets_are_gone(steps):
    before, after = steps["secrets"]
    assert {r["doc_id"] for r in before.collect()} == {r["doc_id"] for r in after.collect()}
    left = secrets.scan(after, None).filter(F.size("base") > 0)
    assert left.isEmpty()
    clean = secrets.scan(before, secrets.train(before)).filter(F.size("secrets") == 0)
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    was = {r["doc_id"]: r["text"] for r in before.collect()}
    assert all(texts[r["doc_id"]] == was[r["doc_id"]] for r in clean.collect())
    assert after.filter(F.char_length("text") != F.col("n_chars")).isEmpty()


def test_pieces_spell_the_texts(steps):
    before, after = steps["pieces"]
    decoded = pieces.decode(after.select("doc_id", "ids"), f"{TOKENIZERS}/piece_bpe_32k.model")
    assert {r["doc_id"]: r["decoded"] for r in decoded.collect()} == {
        r["doc_id"]: r["text"] for r in before.collect()
    }


def test_run_is_all_stages(spark, steps):
    assert rows(corpus_pipeline.run(spark, SF).drop("ids")) == rows(steps["pieces"][1].drop("ids"))


ODD = "doc_id long, text string, lang string, source string, n_chars long, _quality string, base string, ids string"


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows and clashing names."""
    texts = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    known = texts.selectExpr(
        "doc_id", "text", "lang", "source", "n_chars", "'q' AS _quality", "'b' AS base", "'i' AS ids"
    )
    rows = [
        (None, None, None, None, None, None, None, None),
        (900001, None, "en", "s", 0, "q", "b", "i"),
        (900002, "", None, "s", 0, "q", "b", "i"),
        (900003, " \n\t", "en", None, 3, None, "b", "i"),
        (900004, "long words " * 3000, "en", "s", 33000, "q", "b", None),
        (900005, "password=abcdefghijkl0123456789 é🎉", "en", "s", 33, "q", "b", "i"),
        (None, "a text without an id", "en", "s", 20, "q", "b", "i"),
    ]
    return known.unionByName(spark.createDataFrame(rows * 2, ODD)), len(rows)


@pytest.mark.parametrize("place", range(5))
def test_stages_take_odd_rows(spark, place):
    docs, _ = odd_documents(spark)
    name, stage = corpus_pipeline.STAGES[place]
    out = stage(spark, docs, SF)
    got = out.collect()
    if place == 4:
        assert len(got) == docs.count()
        return
    assert out.columns == docs.columns
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    if name == "similar":
        assert sum(r["doc_id"] == 900004 for r in got) == 1
        assert sum(r["doc_id"] == 900001 for r in got) == 2
        assert sum(r["doc_id"] is None for r in got) == 4
    if name == "secrets":
        assert len(got) == docs.count()
        assert by_id[900005]["text"] == "password=[secret] é🎉" and by_id[900005]["n_chars"] == 20
        assert by_id[900001]["text"] is None
    if name == "benchmark":
        assert {900001, 900002, 900003, 900005} <= set(by_id)
    assert stage(spark, docs.limit(0), SF).count() == 0
