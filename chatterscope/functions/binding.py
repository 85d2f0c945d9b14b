"""Naming an intermediate value inside one Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often body uses it.

    Spark may merge projections or push a filter below them, and then repeats an expression
    for each use; a lambda variable is never repeated.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
