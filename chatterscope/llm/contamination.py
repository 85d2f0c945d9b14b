"""Benchmark passages inside documents, found by spaced seeds and verified word by word.

A seed is the hash of the words at a mask's positions in a window; the other positions may
differ. Document seeds meet benchmark seeds in a join; each hit names a diagonal (document
position minus item position), on which words are compared one to one. Masks are chosen such
that every stretch of ``WINDOW`` aligned words with at most ``SUBSTITUTED`` replaced ones holds
an intact seed, so no such overlap is missed. Items too short for that have masks of their own
length (``short_masks``). DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.functions.binding import let
from chatterscope.llm.texts import fresh
from chatterscope.plans.lineage import cut_lineage

WINDOW = 13
SUBSTITUTED = 2
# Positions that count, of nine words each.
MASKS = ((0, 1, 2, 3, 5, 8), (0, 3, 4, 6, 7, 8))
# Items of fewer words are left out where the caller does not ask for them.
SHORTEST = 9
# Rows of 16 to 40 bytes that are broadcast at most; larger sides are joined by shuffle.
MAX_BROADCAST_ROWS = 500_000
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case; none of a null text."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS)
    return F.filter(parts, lambda w: w != "")


def survives(size: int, allowed: int, masks: Sequence[Sequence[int]]) -> bool:
    """Whether any ``allowed`` replaced ones of ``size`` words leave a mask an intact place."""
    places = [{p + o for o in m} for m in masks for p in range(size - max(m))]
    return all(
        any(not place & set(changed) for place in places)
        for changed in combinations(range(size), allowed)
    )


def short_masks(
    size: int, window: int, substituted: int, masks: Sequence[Sequence[int]]
) -> list[tuple[int, tuple[int, ...]]]:
    """(place, mask) of the seeds of items of ``size`` words; none where the masks suffice.

    The words are dealt into two more parts than may be replaced; each choice of two whole
    parts is a mask, and one of them is always intact.
    """
    allowed = substituted * size // window
    if size >= window or survives(size, allowed, masks):
        return []
    parts = min(size, allowed + 2) if allowed else 1
    cuts = [size * i // parts for i in range(parts + 1)]
    whole = [tuple(range(cuts[i], cuts[i + 1])) for i in range(parts)]
    found = [sum(some, ()) for some in combinations(whole, max(1, parts - allowed))]
    return [(m[0], tuple(o - m[0] for o in m)) for m in found]


def seeds(words: Column, masks: Sequence[Sequence[int]] = MASKS) -> Column:
    """The seeds that begin at each word, one of each mask; null for fewer words than a mask.

    Where masks differ in length, those that end behind the last word are left out.
    """
    ends = [max(m) for m in masks]

    def at(h: Column, i: Column) -> Column:
        hashed = [_seed(h, i, n, m) for n, m in enumerate(masks)]
        if min(ends) == max(ends):
            return F.array(*hashed)
        fit = [F.when(i + end < F.size(h), x) for end, x in zip(ends, hashed, strict=True)]
        return F.array_compact(F.array(*fit))

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.when(
            F.size(h) > min(ends),
            F.transform(F.sequence(F.lit(0), F.size(h) - min(ends) - 1), lambda i: at(h, i)),
        ),
    )


def _seed(hashes: Column, at: Column, number: int, mask: Sequence[int]) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(hashes, at + o) for o in mask])


def _each_seed(df: DataFrame, key: str, words: Column, masks: Sequence[Sequence[int]]) -> DataFrame:
    """(key, at, seed): one row per word and mask. Nothing else goes through the expansion."""
    return df.select(key, F.posexplode(seeds(words, masks)).alias("at", "_seeds")).select(
        key, "at", F.explode("_seeds").alias("seed")
    )


def _short_seeds(
    items: DataFrame,
    own: dict[int, list[tuple[int, tuple[int, ...]]]],
    masks: Sequence[Sequence[int]],
) -> DataFrame:
    """(item_id, at, seed) of the items whose size has masks of its own, numbered as in masks."""
    number = {tuple(m): n for n, m in enumerate(masks)}

    def of(h: Column) -> Column:
        each = F.array().cast("array<struct<at:int,seed:bigint>>")
        for size, placed in own.items():
            found = [
                F.struct(F.lit(p).alias("at"), _seed(h, F.lit(p), number[m], m).alias("seed"))
                for p, m in placed
            ]
            each = F.when(F.size(h) == size, F.array(*found)).otherwise(each)
        return each

    hashed = F.transform("item", lambda w: F.xxhash64(w))
    return items.select("item_id", F.inline(let(hashed, of)))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def _bounded_items(items: DataFrame) -> DataFrame:
    """Items hold their words: they are broadcast up to so many words in all."""
    words = items.agg(F.sum(F.size("item"))).first()[0] or 0
    return F.broadcast(items) if words <= MAX_BROADCAST_ROWS else items


def overlaps(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    substituted: int = SUBSTITUTED,
    masks: Sequence[Sequence[int]] = MASKS,
    shortest: int = SHORTEST,
) -> DataFrame:
    """(doc_id, item_id, matched_words, item_words) of each item a document contains a part of.

    A part is a stretch of ``window`` aligned words (the whole item, if it is shorter) of which
    at most ``substituted`` differ, a shorter item's share of that rounded down;
    matched_words are the equal words on the best diagonal. Items of fewer than ``shortest``
    words are not reported (1 asks for all); neither are documents and items that are null or
    without words, nor rows without an id. Repeated rows and ids report once, with their best. Other
    columns are not read. Empty tables give no rows.
    """
    items = cut_lineage(
        benchmark.select("item_id", words_of(F.col("text")).alias("item"))
        .filter(F.col("item_id").isNotNull() & (F.size("item") >= max(1, shortest)))
        .distinct()
    )
    sizes = items.filter(F.size("item") < window).select(F.size("item")).distinct().collect()
    own = {n: short_masks(n, window, substituted, masks) for n in sorted(r[0] for r in sizes)}
    own = {n: placed for n, placed in own.items() if placed}
    more = {m: None for placed in own.values() for _, m in placed}
    every = [*masks, *[m for m in more if m not in masks]]
    usual = items.filter(~F.size("item").isin(*own)) if own else items
    wanted = _each_seed(usual, "item_id", F.col("item"), masks)
    if own:
        wanted = wanted.unionAll(_short_seeds(items, own, every))
    wanted = wanted.distinct().withColumnRenamed("at", "item_at")
    named = documents.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    seen = _each_seed(named, "doc_id", words_of(F.col("text")), every)
    # A short item may begin at very many words: a document is taken apart once for all of them.
    hits = cut_lineage(
        seen.join(_bounded(wanted, wanted.count()), "seed")
        .select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .groupBy("doc_id", "item_id")
        .agg(F.collect_set("diagonal").alias("diagonals"))
    )
    places = hits.agg(F.sum(F.size("diagonals"))).first()[0] or 0
    found_in = documents.select("doc_id", "text").join(_bounded(hits, places), "doc_id")
    # Bound by lambdas: what Spark merged into them would be evaluated for each word.
    size = F.least(F.lit(window), F.size("item"))
    allowed = F.floor(F.lit(substituted) * size / F.lit(window))

    def matched(words: Column) -> Column:
        measured = F.transform(
            "diagonals",
            lambda d: let(_equal_words(words, d), lambda equal: _measured(equal, size)),
        )
        enough = F.filter(measured, lambda m: m["best"] >= size - allowed)
        return F.array_max(F.transform(enough, lambda m: m["matched_words"]))

    compared = found_in.join(_bounded_items(items), "item_id").select(
        "doc_id",
        "item_id",
        F.size("item").alias("item_words"),
        let(words_of(F.col("text")), matched).alias("matched_words"),
    )
    # Filtered after the aggregation: pushed below the projection, it would compare twice.
    best = F.struct("matched_words", "item_words")
    return (
        compared.groupBy("doc_id", "item_id")
        .agg(F.max(F.when(F.col("matched_words").isNotNull(), best)).alias("best"))
        .filter(F.col("best").isNotNull())
        .select("doc_id", "item_id", "best.matched_words", "best.item_words")
    )


def _measured(equal: Column, size: Column) -> Column:
    """The equal words of the best stretch of ``size`` words, and of the whole diagonal."""
    stretch = F.transform(
        F.sequence(F.lit(1), F.size(equal) - size + 1),
        lambda i: F.aggregate(F.slice(equal, i, size), F.lit(0), lambda a, x: a + x),
    )
    total = F.aggregate(equal, F.lit(0), lambda a, x: a + x)
    return F.struct(F.array_max(stretch).alias("best"), total.alias("matched_words"))


def _span(masks: Sequence[Sequence[int]]) -> int:
    return max(max(m) for m in masks) + 1


def _equal_words(words: Column, diagonal: Column) -> Column:
    """1 or 0 for each word of the item: whether the document has it at that place."""
    return F.transform(
        F.col("item"),
        lambda w, i: F.when(F.get(words, diagonal + i) == w, 1).otherwise(0),
    )


def without_benchmark(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that contain no part of the benchmark, all columns as they are.

    Rows with a null id or text stay.
    """
    key = fresh("_found_id", documents.columns)
    found = overlaps(documents, benchmark, **settings).select(F.col("doc_id").alias(key)).distinct()
    found = cut_lineage(found)
    bounded = _bounded(found, found.count())
    return documents.join(bounded, documents["doc_id"] == bounded[key], "left_anti")
