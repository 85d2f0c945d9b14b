"""Searching, merging and de-duplicating post tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.functions.text import extract_hashtags
from chatterscope.plans.joins import ROW_KEY, SENT_ROWS, among, can_key_rows, with_row_key
from chatterscope.plans.lineage import cut_lineage
from chatterscope.schema import SEARCH_HASHTAGS


def search_posts(
    posts: DataFrame,
    hashtags: Sequence[str] = SEARCH_HASHTAGS,
    lang: str = "en",
    k: int | None = None,
) -> DataFrame:
    """Posts of one language with any of the hashtags, the newest ``k`` if it is given; reposts
    are left out."""
    wanted = F.array(*[F.lit(h.lower()) for h in hashtags])
    tags = F.transform(extract_hashtags(F.col("text")), F.lower)
    hits = posts.filter(
        (F.col("lang") == lang)
        & ~F.col("text").startswith("RT @")
        & F.arrays_overlap(tags, wanted)
    )
    return hits if k is None else hits.orderBy(F.desc("ts"), F.desc("post_id")).limit(k)


def merge_posts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name without repeated rows.

    Rows are compared by digests, so texts stay where they are: of each table go the rows whose
    digest an earlier table has, and copies inside a table meet. Whole rows are shuffled only
    where the digests to leave out and those to take are both too many to be sent to all
    tasks, or where nested values have no digest.
    """
    whole = union_posts(first, *others)
    if not can_key_rows(whole):
        return whole.dropDuplicates()
    none = whole.limit(0)
    tables = [with_row_key(union_posts(none, t)) for t in (first, *others)]
    counted = reduce(
        DataFrame.unionAll, [t.select(*ROW_KEY, F.lit(i).alias("at")) for i, t in enumerate(tables)]
    )
    each = range(len(tables))
    digests = cut_lineage(
        counted.groupBy(*ROW_KEY).agg(
            F.min("at").alias("first"), *[F.count_if(F.col("at") == i).alias(f"n{i}") for i in each]
        )
    )
    taken = [F.col("first") == i for i in each]
    left = [(F.col("first") < i) & (F.col(f"n{i}") > 0) for i in each]
    twice = [taken[i] & (F.col(f"n{i}") > 1) for i in each]
    sizes = digests.agg(*[F.count_if(c) for c in (*taken, *left, *twice)]).first()
    merged = none
    for i, table in enumerate(tables):
        n_taken, n_left, n_twice = (sizes[i + part * len(tables)] for part in range(3))
        if n_left > SENT_ROWS >= n_taken:
            table = among(table, digests.filter(taken[i]), n_taken, "left_semi")
        else:
            table = among(table, digests.filter(left[i]), n_left, "left_anti")
        copies = digests.filter(twice[i])
        if n_twice > SENT_ROWS:
            table = table.dropDuplicates(ROW_KEY)
        elif n_twice:
            met = among(table, copies, n_twice, "left_semi").dropDuplicates(ROW_KEY)
            table = among(table, copies, n_twice, "left_anti").unionAll(met)
        merged = merged.unionAll(table.drop(*ROW_KEY))
    return merged


def union_posts(first: DataFrame, *others: DataFrame) -> DataFrame:
    merged = first
    for other in others:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged


def dedup_stats(rows: DataFrame) -> DataFrame:
    """One row: rows, repeated rows, distinct rows. Null equals null here."""
    keys = rows.columns
    if can_key_rows(rows):
        rows, keys = with_row_key(rows).select(*ROW_KEY), ROW_KEY
    copies = rows.groupBy(*keys).agg(F.count("*").alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        F.count("*").alias("distinct_rows"),
    )
