"""The corpus pipeline: from raw documents to piece ids of clean, distinct, fair ones.

Each stage works on all rows that the one before it left and gives the columns of documents,
the last one the encoded texts. ``run`` writes each stage's rows to the shared folder and
reads them again, so nothing is computed twice and a lost executor costs one stage at most.

All stages but the last keep every column, whatever it is called; helper columns take free
names. Whole texts are read, however long. An empty table goes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm import contamination, pieces, quality, secrets, similar
from chatterscope.llm.queries import (
    QUALITY_BAR,
    SEGMENTATIONS,
    TOKENIZERS,
    quality_model,
    table,
)
from chatterscope.llm.texts import fresh
from chatterscope.plans.lineage import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the bar; the labels teach it.

    A null text is judged as an empty one. Repeated rows score alike, so all stay or go; without
    labels every document scores 0.5 and stays.
    """
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    name = fresh("_quality", docs.columns)
    scored = quality.score(docs, model, keep=tuple(docs.columns), name=name)
    return scored.filter(F.col(name) >= QUALITY_BAR).select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its 5-word shingles.

    Of a group the row of smallest doc_id stays, one of them if rows repeat. Rows without an id
    or a word all stay, as do unlike texts under one id.
    """
    return similar.without_similar(docs, similar.Rule(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a part of a benchmark item.

    Null and empty texts hold none and stay, as do rows without an id. Repeated rows go alike.
    """
    return contamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"), shortest=1)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked; n_chars follows the text.

    No row goes. A null text stays null, with a null n_chars; repeated rows are masked alike.
    """
    clean = secrets.redact(docs, secrets.train(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.char_length("text").cast(kind))
    return clean


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the pieces of the best segmentation with its score; how many
    segmentations were found, how far the second and the last score behind it, and in how many
    places all of them differ from it.

    A row for each document, repeated ones and null ids included. A null text is encoded as an
    empty one; of equal scores the search's first counts, which depends on the text only.
    """
    encoded = pieces.encode(
        docs, f"{TOKENIZERS}/piece_bpe_32k.model", SEGMENTATIONS, keep=("doc_id", "lang", "source")
    )
    best = F.get("scores", F.lit(0))
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_pieces"),
        best.alias("score"),
        "ids",
        F.size("scores").alias("n_best"),
        (best - F.get("scores", F.lit(1))).alias("margin"),
        F.when(F.size("scores") > 1, best - F.element_at("scores", -1)).alias("last_margin"),
        F.size(F.flatten("alternatives")).cast("long").alias("n_edits"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("similar", keep_one_of_similar),
    ("benchmark", drop_contaminated),
    ("secrets", redact_secrets),
    ("pieces", encode_pieces),
]

# A fitted classifier, Markov models and a segmentation search are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
