"""Counting and ranking helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, output: str = "n") -> DataFrame:
    """Rows per key, null keys left out; a hot key is summed up before the shuffle.

    Nulls go by their count, since a filter on the keys would be pushed below whatever
    computes them and compute them twice.
    """
    known = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        known = known & F.col(key).isNotNull()
    counted = df.groupBy(*keys).agg(F.count_if(known).alias(output))
    return counted.filter(F.col(output) > 0)


def top(df: DataFrame, by: str, *ties: str, k: int) -> DataFrame:
    """First k rows by ``by`` descending (nulls last), ties by key ascending."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc(t) for t in ties]).limit(k)


def explode_names(posts: DataFrame, names, output: str) -> DataFrame:
    """One row per element; the outer form keeps Spark from extracting twice to pre-filter."""
    return posts.select(F.explode_outer(names).alias(output)).filter(F.col(output).isNotNull())
