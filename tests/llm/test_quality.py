import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatterscope.llm import language, quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, label int, counts string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 0.1, 1, "x") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def fitted(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return quality.fit(documents, labels.filter(language.fold_of(F.col("doc_id"), 5) != 0))


def test_held_out_labels_are_told_apart(spark, fitted):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(language.fold_of(F.col("doc_id"), 5) == 0)
    got = quality.score(documents.join(labels, "doc_id"), fitted, keep=("quality",)).toPandas()
    right = (got["score"] >= 0.3) == (got["quality"] == 1)
    assert right.mean() >= 0.95


def test_votes_are_those_of_all_labelled_texts(fitted):
    texts = pa.array(["The cat sat. It ran.", "X!! Y!! Z!!", "", None, "a" * 100_000])
    (_, _, counts), = quality.term_counts(texts)
    vectors = fitted.latent(counts)
    for row, got in zip(vectors, fitted.score(counts), strict=True):
        near = fitted.vectors @ row
        best = np.argsort(-near, kind="stable")[: fitted.neighbours]
        weight = np.clip(near[best], 1e-6, None) ** fitted.power
        assert got == pytest.approx((weight * fitted.labels[best]).sum() / weight.sum(), abs=0.08)


def test_every_row_has_a_score(spark, fitted):
    rows = [None, "", " ", "word", "word", "x " * 60_000, "é\u0000🎉"]
    df = frame(spark, rows)
    got = quality.score(df, fitted, keep=tuple(df.columns), name="found").collect()
    assert len(got) == len(rows) and all(0 <= r["found"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["found"] for r in got}
    assert by_id[3] == by_id[4] and by_id[0] == by_id[1]
    assert quality.score(df.limit(0), fitted).isEmpty()
    assert {r["score"] for r in quality.score(df, None).collect()} == {0.5}


def test_nothing_to_learn(spark):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert quality.fit(frame(spark, ["a", "b"]), labels) is None
    few = spark.createDataFrame([(1, 1), (1, 0), (7, 1)], "doc_id long, quality int")
    one = quality.fit(frame(spark, ["a", "b"]), few)
    assert one.labels.tolist() == [0.0]


def test_scores_are_given_to_spark_a_chunk_at_a_time(spark, monkeypatch):
    from chatterscope.llm import quality, texts

    rows = [(i, f"word{i} and {'more ' * (i % 7)}text", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").coalesce(1)
    model = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    want = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    assert len(want) == 40
    counted = []

    class Documents:
        schema, columns, sparkSession = df.schema, df.columns, spark

        def select(self, *names):
            self.names = names
            return self if "text" in names else df.select(*names)

        def mapInArrow(self, run, _):
            counted.extend(run(df.select(*self.names).toArrow().to_batches()))

    monkeypatch.setattr(texts.chunks, "__defaults__", (100,))
    quality.score(Documents(), model)
    assert len(counted) > 5 and {r["doc_id"]: r["score"] for b in counted for r in b.to_pylist()} == want
