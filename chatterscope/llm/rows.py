"""Rows of documents by (id, digest), the texts they share, and what is marked in them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.plans.lineage import cut_lineage

LEAST_ID = -(1 << 63)


def keyed(documents: DataFrame) -> DataFrame:
    """(id, digest, text): a null id is before all others, a null text empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("id"),
        F.xxhash64(text, F.length(text)).alias("digest"),
        text.alias("text"),
    )


def packed(rows: DataFrame) -> DataFrame:
    """(id, digest, packed): the texts compressed, for those that are dealt out whole."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shrink = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [shrink(t.as_py().encode()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.binary())], ["id", "digest", "packed"]
            )

    return rows.select("id", "digest", "text").mapInArrow(
        # Not null, or an inner and a left join would not share their exchange.
        run, "id long not null, digest long not null, packed binary not null"
    )


def unpacked(column: pa.Array) -> list[bytes]:
    """The texts of a column of packed ones, as UTF-8."""
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    return [expand(t.as_py()) for t in column]


def doc_id() -> Column:
    return F.when(F.col("id") != LEAST_ID, F.col("id")).alias("doc_id")


def leads(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(digest, id): the smallest id of each text; (id, digest): the other rows of such texts."""
    small = cut_lineage(rows.select("id", "digest").distinct())
    first = small.groupBy("digest").agg(F.min("id").alias("id"))
    lead = first.withColumnRenamed("id", "lead")
    return first, small.join(lead, "digest").filter("lead < id").select("id", "digest")


def with_runs(texts: DataFrame, runs: DataFrame, copies: DataFrame) -> DataFrame:
    """(id, packed, copy, runs): each row's (start, size) runs, in any order, and if it is a copy.

    ``runs`` (id, digest, start, size) are of leading rows only, so a row has one mark. The
    texts are dealt out by (id, digest), as for the search, so one exchange serves both.
    """
    kind = "array<struct<start: int, size: int>>"
    marked = runs.groupBy("id", "digest").agg(
        F.collect_list(F.struct("start", "size")).alias("runs")
    )
    marks = marked.select("id", "digest", F.lit(False).alias("copy"), F.col("runs").cast(kind))
    marks = marks.unionAll(
        copies.select("id", "digest", F.lit(True).alias("copy"), F.lit(None).cast(kind))
    )
    joined = texts.join(marks, ["id", "digest"], "left")
    return joined.select("id", "packed", F.coalesce("copy", F.lit(False)).alias("copy"), "runs")
