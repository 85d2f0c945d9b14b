"""Exact nearest neighbours by a block matrix join.

Vectors are packed into blocks; every candidate block meets every block of the stated query
set once. A tile is the integer product of 8-bit codes; with the exact norms of the coding
errors it bounds every distance from both sides. Pairs whose lower bound is above the k-th
smallest upper bound of an id go; the others are computed again in double precision from the original
vectors, and heaps merge the tiles of a task and then the tasks of a query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.plans.lineage import cut_lineage

# Bytes of doubles in a candidate block and in a query block, whatever the vectors' length;
# a vector longer than a block has one of its own.
CANDIDATE_BYTES = 2 << 20
QUERY_BYTES = 8 << 20
# Bytes of the query vectors that one pass over all vectors broadcasts.
ROUND_BYTES = 64 << 20
# A tile is worked off in strips of so many queries, which bounds its memory.
STRIP = 128
# Integer sums below 2 ** 24 are exact in single precision: 127 * 127 * 1024 < 2 ** 24.
EXACT_DIMS = 1024

BLOCK = "n int, dims int, ids binary, data binary"
FOUND = "query_id long, vec_id long, score double"
RANKED = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that take part: an id, no null or non-finite component, not zero.

    NaN orders above infinity here, so one comparison keeps both out.
    """
    v = F.col(vector).cast("array<double>")
    return (
        vectors.select(F.col(vector_id).cast("long").alias("id"), v.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .filter(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
        .filter(F.exists("v", lambda x: x != 0))
    )


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Pack (id, v) into blocks of ``size`` bytes of vectors of the same length, by partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            begin = np.cumsum(lengths) - lengths
            for dims in np.unique(lengths):
                mine = np.flatnonzero(lengths == dims)
                rows = flat[begin[mine][:, None] + np.arange(dims)]
                waiting.setdefault(int(dims), []).append((ids[mine], rows))
                if sum(r.nbytes for _, r in waiting[int(dims)]) >= size:
                    yield from _packed(int(dims), waiting.pop(int(dims)), size)
        for dims, parts in waiting.items():
            yield from _packed(dims, parts, size)

    return vectors.select("id", "v").mapInArrow(run, BLOCK)


def _packed(dims: int, parts: list, size: int) -> Iterator[pa.RecordBatch]:
    ids = np.concatenate([i for i, _ in parts]).astype(np.int64)
    rows = np.concatenate([r for _, r in parts])
    step = max(1, size // (8 * dims))
    for at in range(0, len(ids), step):
        some, data = ids[at : at + step], rows[at : at + step]
        yield pa.RecordBatch.from_pydict(
            {
                "n": pa.array([len(some)], pa.int32()),
                "dims": pa.array([dims], pa.int32()),
                "ids": [some.tobytes()],
                "data": [data.tobytes()],
            }
        )


class Coded:
    """Vectors with their 8-bit codes and the norms that bound what the codes lose."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.scale = np.abs(rows).max(1) / 127.0
        self.codes = np.rint(rows / self.scale[:, None]).astype(np.int8)
        near = self.codes * self.scale[:, None]
        self.norm = np.linalg.norm(rows, axis=1)
        self.near_norm = np.linalg.norm(near, axis=1)
        self.lost = np.linalg.norm(rows - near, axis=1)


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of 8-bit codes, as doubles."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMS):
        part = slice(at, at + EXACT_DIMS)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def square_bounds(queries: Coded, others: Coded) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of all pairs.

    With x = x' + e: x.y - x'.y' = e.y + x'.f, so the product is off by |e||y| + |x'||f| at most;
    a margin covers the rounding of the doubles.
    """
    product = code_products(queries.codes, others.codes)
    product *= queries.scale[:, None] * others.scale[None, :]
    off = queries.lost[:, None] * others.norm[None, :]
    off += queries.near_norm[:, None] * others.lost[None, :]
    squares = (queries.norm**2)[:, None] + (others.norm**2)[None, :]
    off = 2 * off + 1e-9 * squares
    middle = squares - 2 * product
    return middle - off, middle + off


def tile(
    queries: Coded, query_ids: np.ndarray, others: Coded, ids: np.ndarray, heaps: dict, k: int
) -> None:
    """Put the pairs of one tile that can be among the k nearest into the queries' heaps.

    The bar is over ids, each with its smallest upper bound, as results count an id once.
    """
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1)) if len(ids) else order
    for at in range(0, len(query_ids), STRIP):
        part = slice(at, at + STRIP)
        strip = Coded.__new__(Coded)
        for name, value in vars(queries).items():
            setattr(strip, name, value[part])
        low, high = square_bounds(strip, others)
        own = query_ids[part][:, None] == ids[None, :]
        low[own], high[own] = np.inf, np.inf
        bar = np.full(len(low), np.inf)
        if len(first) > k:
            if len(first) < len(ids):
                high = np.minimum.reduceat(high[:, order], first, axis=1)
            bar = np.partition(high, k - 1, axis=1)[:, k - 1]
        for i, q in enumerate(query_ids[part].tolist()):
            heap = heaps.setdefault(q, [])
            limit = min(bar[i], (heap[0][0] ** 2) * (1 + 1e-9) if len(heap) == k else np.inf)
            left = np.flatnonzero((low[i] <= limit) & ~own[i])
            if not len(left):
                continue
            # Squares are added one after another, so equal vectors give equal scores anywhere.
            squares = (others.rows[left] - strip.rows[i]) ** 2
            score = np.sqrt(np.add.accumulate(squares, axis=1)[:, -1])
            merge(heap, zip((-score).tolist(), (-ids[left]).tolist(), strict=True), k)


def merge(heap: list, found: Iterable[tuple[float, int]], k: int) -> None:
    """Keep the k nearest as (-score, -id) in a heap whose top is the farthest; an id counts once."""
    for pair in found:
        if len(heap) == k and pair <= heap[0]:
            continue
        same = next((i for i, x in enumerate(heap) if x[1] == pair[1]), None)
        if same is not None:
            if heap[same] < pair:
                heap[same] = pair
                heapq.heapify(heap)
        elif len(heap) < k:
            heapq.heappush(heap, pair)
        else:
            heapq.heapreplace(heap, pair)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vector_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of each query, exactly.

    Nearest first by Euclidean distance in double precision, ties to the smaller id, the
    query's own id left out; fewer than k where there are fewer candidates of the query's
    length. Vectors that are null, zero or hold a null or non-finite component take no part,
    nor do rows without an id. Repeated rows count once; where an id has several vectors, its
    nearest counts, and a query takes the smallest of its vectors. Empty tables give no rows;
    other columns are not read.
    """
    asked = usable(queries, vector_id, vector).groupBy("id").agg(F.min("v").alias("v"))
    total = asked.agg(F.sum(F.size("v").cast("long") * 8)).first()[0]
    if total is None:
        return vectors.sparkSession.createDataFrame([], RANKED)
    rounds = -(-total // ROUND_BYTES)
    asked = asked.withColumn("round", F.pmod(F.xxhash64("id"), F.lit(rounds)).cast("int"))
    if rounds > 1:
        asked = cut_lineage(asked)
    packed = blocks(usable(vectors, vector_id, vector), CANDIDATE_BYTES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list] = {}
        last, coded, ids = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["qids"] != last:
                    last = row["qids"]
                    ids = np.frombuffer(last, np.int64)
                    coded = Coded(np.frombuffer(row["qdata"]).reshape(row["qn"], row["dims"]))
                others = Coded(np.frombuffer(row["data"]).reshape(row["n"], row["dims"]))
                tile(coded, ids, others, np.frombuffer(row["ids"], np.int64), heaps, k)
        rows = [(q, -i, -s) for q, heap in heaps.items() for s, i in heap]
        if rows:
            query, found, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "query_id": pa.array(query, pa.int64()),
                    "vec_id": pa.array(found, pa.int64()),
                    "score": pa.array(score, pa.float64()),
                }
            )

    def best(found: pd.DataFrame) -> pd.DataFrame:
        heap: list = []
        merge(heap, zip((-found["score"]).tolist(), (-found["vec_id"]).tolist(), strict=True), k)
        ordered = sorted(heap, reverse=True)
        return pd.DataFrame(
            {
                "query_id": found["query_id"].iloc[0],
                "rank": np.arange(1, len(ordered) + 1, dtype=np.int32),
                "vec_id": [-i for _, i in ordered],
                "score": [-s for s, _ in ordered],
            }
        )

    partial = None
    for number in range(rounds):
        # A round has about ROUND_BYTES, whatever the size of the tables: a bounded broadcast.
        one = blocks(asked.filter(F.col("round") == number).coalesce(1), QUERY_BYTES)
        one = one.toDF("qn", "dims", "qids", "qdata")
        tiles = packed.join(F.broadcast(one), "dims")
        tiles = tiles.select("dims", "n", "ids", "data", "qn", "qids", "qdata")
        found = tiles.mapInArrow(run, FOUND)
        partial = found if partial is None else partial.unionAll(found)
    return partial.groupBy("query_id").applyInPandas(best, RANKED)
