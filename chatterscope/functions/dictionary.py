"""Word lookups that stay inside the row.

A dictionary (lexicon, lemmas, places) of checked size becomes one constant: an array
of small maps, picked by the hash of the word. Looking a token up then needs neither a
shuffle nor a Python worker, however many tokens a post has. Callers join dictionaries beyond
the bound instead, with the same result.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_INLINE_ENTRIES = 20_000
ENTRIES_PER_BUCKET = 4


class Inline:
    """A dictionary that goes to the tasks with the plan: as a lookup Column, and as ``entries``."""

    def __init__(self, find: Callable[[Column], Column], entries: dict[str, tuple]) -> None:
        self.find, self.entries = find, entries

    def __call__(self, c: Column) -> Column:
        """The struct of the other columns for a key, null if unknown."""
        return self.find(c)

    def firsts(self) -> dict:
        """The first of the other columns by key."""
        return {key: values[0] for key, values in self.entries.items()}


def inline_lookup(
    entries: DataFrame, key: str, limit: int = MAX_INLINE_ENTRIES
) -> Inline | None:
    """Lookup from a key to the other columns.

    None if ``entries`` has more than ``limit`` rows: at most limit + 1 reach the driver.
    Of a repeated key the smallest values win, null keys and null values are left out.
    """
    values = [c for c in entries.columns if c != key]
    value_type = entries.select(*values).schema.simpleString()
    rows = (
        entries.dropna()
        .select(
            F.xxhash64(key).alias("hash"),
            F.col(key).alias("key"),
            F.struct(*values).alias("value"),
        )
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        return None
    slots = max(1, len(rows) // ENTRIES_PER_BUCKET)
    buckets: list[dict] = [{} for _ in range(slots)]
    known: dict[str, tuple] = {}
    for row in sorted(rows, key=lambda r: tuple(r["value"]), reverse=True):
        buckets[row["hash"] % slots][row["key"]] = row["value"].asDict()
        known[row["key"]] = tuple(row["value"])
    table = F.from_json(
        F.lit(json.dumps(buckets, ensure_ascii=False)), f"array<map<string,{value_type}>>"
    )

    def find(c: Column) -> Column:
        slot = F.pmod(F.xxhash64(c), F.lit(slots)).cast("int")
        return F.try_element_at(F.get(table, slot), c)

    return Inline(find, known)
