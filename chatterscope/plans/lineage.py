"""Shared scratch space: where iterative jobs cut their lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without the setting uses its warehouse folder.
    """
    named = spark.conf.get(SETTING, None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder shared by the cluster")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize df in the shared folder, so that lost executors cost no recompute chain."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
