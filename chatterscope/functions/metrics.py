"""Casts and sums over the engagement metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def present(df: DataFrame, metrics: Sequence[str]) -> list[str]:
    """The metrics this table has."""
    return [m for m in metrics if m in df.columns]


def as_int(name: str) -> Column:
    """Integer, or null where the text is not one."""
    return F.col(name).try_cast("int")


def as_number(name: str) -> Column:
    """Double, or 0 where the text is no number."""
    text = F.col(name).cast("string")
    return F.coalesce(F.when(text.rlike(NUMBER), text.try_cast("double")), F.lit(0.0))


def row_total(columns: Sequence[Column]) -> Column:
    """Sum across columns; null as soon as one is null."""
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total


def post_engagement(metrics: Sequence[str]) -> Column:
    return row_total([as_int(m).cast("bigint") for m in metrics])


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def percent_text(c: Column) -> Column:
    return F.concat(c.cast("string"), F.lit("%"))
