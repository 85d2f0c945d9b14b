"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterscope.functions import words
from chatterscope.functions.dictionary import MAX_INLINE_ENTRIES, inline_lookup
from chatterscope.plans.lineage import cut_lineage

# A key is hot above this share of the rows, so there are fewer than 1 / HOT_SHARE
# hot keys: that bounds the list the driver holds, whatever the size of the data.
HOT_SHARE = 0.001
# Below this many rows a single key is no burden to a task.
HOT_FLOOR = 100_000
BUCKETS = 32
SALT = "_salt"


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def hot_keys(counts: DataFrame, key: str, floor: int | None = None) -> list:
    """Keys of ``counts(key, n)`` with more than HOT_SHARE of all rows and ``floor`` rows."""
    floor = HOT_FLOOR if floor is None else floor
    sizes = counts.agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    bar = max(floor, (sizes["total"] or 0) * HOT_SHARE)
    if (sizes["largest"] or 0) <= bar:
        return []
    return [row[0] for row in counts.filter(F.col("n") > bar).select(key).collect()]


def salt_rows(df: DataFrame, key: str, hot: list, by: list[str]) -> DataFrame:
    """Give rows of a hot key one of BUCKETS salts, decided by the columns ``by``."""
    salt = F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int")
    return df.withColumn(SALT, F.when(F.col(key).isin(hot), salt).otherwise(0))


def spread_rows(df: DataFrame, key: str, hot: list) -> DataFrame:
    """Copy rows of a hot key to every salt."""
    every = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    salts = F.when(F.col(key).isin(hot), every).otherwise(F.array(F.lit(0)))
    return df.withColumn(SALT, F.explode(salts))


def salted_join(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    by: list[str] | None = None,
    counts: DataFrame | None = None,
    floor: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Join on ``key`` (inner, left, left_semi or left_anti), splitting the hot keys of ``rows``.

    ``by`` names the columns that tell rows of one key apart, ``counts`` the row count per
    key if the caller has it already, ``at_most`` a bound on the rows if it is known: few
    rows have no hot key to look for. Null keys match nothing, as in any equi join.
    """
    floor = HOT_FLOOR if floor is None else floor
    if at_most is not None and at_most <= floor:
        return rows.join(dim, key, how)
    counts = key_counts(rows, key) if counts is None else counts
    hot = hot_keys(counts, key, floor)
    if not hot:
        return rows.join(dim, key, how)
    by = by or [c for c in rows.columns if c != key]
    joined = salt_rows(rows, key, hot, by).join(spread_rows(dim, key, hot), [key, SALT], how)
    return joined.drop(SALT)


# Tables of so many rows, and so many characters in them, are sent to all tasks.
SENT_ROWS = 1_000_000
SENT_CHARS = 64 << 20


def sent_or_salted(
    rows: DataFrame, dim: DataFrame, key: str, how: str = "inner", by: list[str] | None = None
) -> DataFrame:
    """``salted_join``, or none of its shuffles while the counted size of ``dim`` lets it be sent
    to all tasks. ``dim`` is read twice, so it has to be kept already."""
    chars = F.sum(F.length(F.to_json(F.struct(*dim.columns))))
    size = dim.agg(F.count("*").alias("n"), chars.alias("chars")).first()
    if size["n"] <= SENT_ROWS and (size["chars"] or 0) <= SENT_CHARS:
        return rows.join(F.broadcast(dim), key, how)
    return salted_join(rows, dim, key, how, by)


# A dictionary of so many entries, and so many characters in them, goes to the tasks as two arrays.
ENTRY_ROWS = 8_000_000
ENTRY_CHARS = 256 << 20


def sent_entries(known: DataFrame) -> Broadcast | None:
    """The kept dictionary (token, value) for lookups inside the rows; none where its counted size
    is too large for that."""
    chars = F.sum(F.length("token") + F.length(F.col("value").cast("string")))
    size = known.agg(F.count("*").alias("n"), chars.alias("chars")).first()
    if size["n"] > ENTRY_ROWS or (size["chars"] or 0) > ENTRY_CHARS:
        return None
    found = known.select("token", "value").toArrow()
    pair = tuple(found[c].combine_chunks() for c in ("token", "value"))
    return known.sparkSession.sparkContext.broadcast(pair)


ROW_KEY = ["_row_a", "_row_b"]


def can_key_rows(df: DataFrame) -> bool:
    """Whether ``with_row_key`` tells all rows apart: nulls inside nested values are not hashed."""
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    return not any(isinstance(f.dataType, nested) for f in df.schema.fields)


def with_row_key(df: DataFrame) -> DataFrame:
    """Add a 128-bit digest of the row, in which a null is a value of its own."""
    parts = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    digests = [F.xxhash64(F.lit(seed), *parts) for seed in range(len(ROW_KEY))]
    return df.withColumns(dict(zip(ROW_KEY, digests, strict=True)))


def among(rows: DataFrame, keys: DataFrame, n: int, how: str) -> DataFrame:
    """``rows`` with (left_semi) or without (left_anti) those of the ``n`` row keys ``keys``, in
    place while these are few."""
    if n == 0:
        return rows if how == "left_anti" else rows.limit(0)
    keys = keys.select(*ROW_KEY)
    return rows.join(F.broadcast(keys) if n <= SENT_ROWS else keys, ROW_KEY, how)


CONTENT = ["_content_a", "_content_b"]


def with_content(df: DataFrame, column: str) -> DataFrame:
    """Add a 128-bit digest of an array column: rows of equal content meet under one key."""
    digests = [F.xxhash64(F.lit(seed), column) for seed in range(len(CONTENT))]
    return df.withColumns(dict(zip(CONTENT, digests, strict=True)))


def contents(named: DataFrame, column: str) -> DataFrame:
    """Each content once. The value is any row's, as all of one digest are equal."""
    return named.filter(F.col(column).isNotNull()).select(*CONTENT, column).dropDuplicates(CONTENT)


def values_of(entries: DataFrame, key: str, value: str) -> DataFrame:
    """(token, value) without nulls; the smallest value of a repeated key wins."""
    pairs = entries.select(F.col(key).alias("token"), F.col(value).alias("value")).dropna()
    return pairs.groupBy("token").agg(F.min("value").alias("value"))


@dataclass
class Lookup:
    """A table whose token column was looked up: how to read an element's token and value."""

    df: DataFrame
    token: Callable[[Column], Column]
    value: Callable[[Column], Column]
    # The dictionary, where it goes to the tasks.
    entries: words.Entries | None = None


def lookup_tokens(
    df: DataFrame,
    tokens: str,
    entries: DataFrame,
    key: str,
    value: str,
    inline_limit: int = MAX_INLINE_ENTRIES,
) -> Lookup:
    """Look each element of the array column ``tokens`` up in ``entries``.

    A dictionary of checked size is looked up inside the row: as a constant of the plan, or sent to
    the tasks. For a larger one each distinct array is taken apart once, joined by token with hot ones
    salted, and its answers, never more than its own tokens, come back by position. Rows are told
    apart by what they hold, so ids may repeat or be null, and all ways give the same.
    """
    pairs = entries.select(F.col(key).alias("token"), F.col(value).alias("value"))
    find = inline_lookup(pairs, "token", inline_limit)
    if find is not None:
        return Lookup(df, lambda t: t, lambda t: find(t)["value"], find.firsts())

    known = cut_lineage(values_of(entries, key, value))
    sent = sent_entries(known)
    if sent is not None:
        kind = known.schema["value"].dataType.simpleString()
        pairs = words.column(
            words.looked_up, f"array<struct<token: string, value: {kind}>>", F.col(tokens), sent
        )
        paired = df.withColumn(tokens, pairs)
        return Lookup(paired, lambda pair: pair["token"], lambda pair: pair["value"], sent)
    named = with_content(df, tokens)
    rows = contents(named, tokens).select(*CONTENT, F.posexplode(tokens).alias("_pos", "token"))
    found = salted_join(rows, known, "token", "left", by=CONTENT)
    answers = found.groupBy(*CONTENT).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_pos", "token", "value"))),
            lambda s: F.struct(s["token"].alias("token"), s["value"].alias("value")),
        ).alias("_found")
    )
    nothing = F.array().cast(answers.schema["_found"].dataType)
    looked_up = F.when(F.col(tokens).isNotNull(), F.coalesce("_found", nothing))
    paired = named.join(answers, CONTENT, "left").withColumn(tokens, looked_up)
    return Lookup(
        paired.drop("_found", *CONTENT), lambda pair: pair["token"], lambda pair: pair["value"]
    )
