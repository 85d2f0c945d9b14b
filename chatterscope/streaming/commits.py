"""Batches of a stream that count once they are committed.

A batch is written to a folder of its own attempt, then a record names that attempt. Readers
take the attempts that records name, so neither a half-written folder nor the leftover of an
attempt that failed is ever read, and nothing a reader may be reading is overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, path: str, form: str, schema: str) -> DataFrame:
    """The rows under ``path``, none if it is not there yet."""
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _records(path: str) -> str:
    return f"{path.rstrip('/')}/commits"


def commit(spark: SparkSession, path: str, batch_id: int, attempt: str) -> None:
    """Record that ``attempt`` holds the batch: one small file, which appears by a rename."""
    record = spark.createDataFrame([(attempt,)], "attempt string").coalesce(1)
    record.write.mode("append").json(f"{_records(path)}/batch={batch_id}")


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    record = _read(spark, f"{_records(path)}/batch={batch_id}", "json", "attempt string")
    return not record.isEmpty()


def committed_batches(
    path: str, record: Callable[[SparkSession, str, int, str], None] = commit
) -> Callable[[DataFrame, int], None]:
    """Batch writer for ``start_hashtags``: a batch that is run again is written once.

    A batch without rows writes nothing. What a failed attempt wrote stays as an unread folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, path, batch_id):
            return
        attempt = uuid.uuid4().hex
        found = batch.persist()
        if not found.isEmpty():
            found.write.parquet(f"{path.rstrip('/')}/data/batch={batch_id}/attempt={attempt}")
            record(spark, path, batch_id, attempt)
        found.unpersist()

    return write


def read_committed(spark: SparkSession, path: str, schema: str = "hashtag string") -> DataFrame:
    """The rows of all committed batches, with ``batch``; an empty table before the first.

    Two drivers that ran one batch at once may both have recorded it: the least attempt counts.
    """
    records = _read(spark, _records(path), "json", "attempt string, batch long")
    named = records.groupBy("batch").agg(F.min("attempt").alias("attempt"))
    rows = _read(
        spark, f"{path.rstrip('/')}/data", "parquet", f"{schema}, batch long, attempt string"
    )
    return rows.join(named, ["batch", "attempt"], "left_semi").drop("attempt")
