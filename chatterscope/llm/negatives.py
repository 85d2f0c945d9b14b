"""Hard negatives by angular triangle filtering.

Each vector, as integers, is stored with its norm and its angles to some reference directions.
Two vectors' own angle is at least the largest difference of their angles to a direction, and
at most the smallest sum, so its cosine lies in an interval; times the norms, and widened for
rounding, that bounds their score. Only pairs whose bounds overlap a window that is still
open are scored, in integers. First windows: the best rows of the anchor's label. Then, for
each of these positives, the scores that make a row of another label a hard negative.

Anchors and rows meet in the cells of a grid: a cell holds a bounded number of bytes of either,
and each pair of them meets in one cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterscope.plans.lineage import cut_lineage

# Reference directions, and vectors among which they are chosen. They change no result.
DIRECTIONS = 16
CHOSEN_FROM = 512
# Bytes of rows and of anchors in a cell, and rows that are bounded together.
ROW_BYTES = 16 << 20
ANCHOR_BYTES = 4 << 20
TILE = 256
# Rows that a cell need not go below, where there are tasks to spare.
CELL_ROWS = 1024
# Stored angles are single precision; a cosine's error near 1 is a larger error of its angle.
ANGLE_SLACK = 2e-6
# Longer integer vectors take no part: a hundredfold score has to fit into 64 bits.
LONGEST = float(1 << 28)
LEAST, MOST = -(1 << 62), 1 << 62

FOUND = "key long, place int, id long, score long"
Windows = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def usable(
    vectors: DataFrame, asked: Column, scale: int, vector_id: str, label: str, vector: str
) -> DataFrame:
    """(id, label, v, norm, asked): rows with an id, a label and whole vectors, as integers."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(
        F.col(vector_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        x.alias("x"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    ).filter(
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("x").isNotNull()
        # NaN orders above all numbers here.
        & F.forall("x", lambda c: c.isNotNull() & (F.abs(c * scale) < LONGEST))
    )
    whole = F.transform("x", lambda c: F.floor(c * scale).cast("int"))
    rows = rows.select("id", "label", whole.alias("v"), "asked")
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return rows.withColumn("norm", F.sqrt(squares)).filter(F.col("norm") < LONGEST)


def directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors far from each other, by number of dimensions, from a bounded sample.

    Any would do. The sample is the ``CHOSEN_FROM`` vectors of smallest hash.
    """
    some = rows.select("v").orderBy(F.xxhash64("v"), "v").limit(CHOSEN_FROM).collect()
    by_dims: dict[int, list] = {}
    for row in some:
        if any(row["v"]):
            by_dims.setdefault(len(row["v"]), []).append(row["v"])
    return {dims: far_apart(np.array(found, float)) for dims, found in by_dims.items()}


def far_apart(vectors: np.ndarray) -> np.ndarray:
    """Directions of ``vectors``, each the farthest from those before it."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(DIRECTIONS, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles(vectors: np.ndarray, norm: np.ndarray, to: np.ndarray | None) -> np.ndarray:
    """Angles of each vector to each direction; the axes where none were chosen, null vectors at 0."""
    if to is None:
        to = np.eye(min(DIRECTIONS, max(1, vectors.shape[1])), vectors.shape[1])
    cosines = (vectors @ to.T) / np.where(norm > 0, norm, 1.0)[:, None]
    return np.where(norm[:, None] > 0, np.arccos(np.clip(cosines, -1.0, 1.0)), 0.0)


def with_angles(rows: DataFrame, chosen: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` and their angles to the directions of their number of dimensions."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, norm = batch.column(2), batch.column(3).to_numpy()
            out: list[np.ndarray | None] = [None] * batch.num_rows
            for dims, mine, vectors in by_length(lists):
                found = angles(vectors, norm[mine], chosen.get(dims)).astype(np.float32)
                for i, one in zip(mine.tolist(), found, strict=True):
                    out[i] = one
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.list_(pa.float32()))], names
            )

    names = ["id", "label", "v", "norm", "asked", "angles"]
    return rows.select(*names[:-1]).mapInArrow(
        run, "id long, label long, v array<int>, norm double, asked boolean, angles array<float>"
    )


def by_length(lists: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their values as doubles) of the lists of each length."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten() if isinstance(lists, pa.Array) else lists.combine_chunks().flatten()
    values = flat.to_numpy(zero_copy_only=False)
    begin = np.cumsum(lengths) - lengths
    for dims in np.unique(lengths).tolist():
        mine = np.flatnonzero(lengths == dims)
        yield dims, mine, values[begin[mine][:, None] + np.arange(dims)].astype(float)


@dataclass
class Side:
    """Rows of one number of dimensions."""

    id: np.ndarray
    label: np.ndarray
    v: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    def of(self, rows: np.ndarray | slice) -> Side:
        return Side(*(x[rows] for x in vars(self).values()))


def sides(table: pa.Table) -> Iterator[tuple[int, np.ndarray, Side]]:
    """The rows of a table by number of dimensions, and where they are in it."""
    flat = {n: table.column(n).to_numpy() for n in ("id", "label", "norm")}
    found = {}
    for _, mine, values in by_length(table.column("angles")):
        for i, row in zip(mine.tolist(), values, strict=True):
            found[i] = row
    for dims, mine, v in by_length(table.column("v")):
        own = np.array([found[i] for i in mine.tolist()])
        yield dims, mine, Side(flat["id"][mine], flat["label"][mine], v, flat["norm"][mine], own)


def interval(
    closest: np.ndarray, widest: np.ndarray, least: np.ndarray, most: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores at angles from ``closest`` to ``widest`` and norms' products between."""
    top = np.cos(np.clip(closest - ANGLE_SLACK, 0, np.pi))
    low = np.cos(np.clip(widest + ANGLE_SLACK, 0, np.pi))
    margin = 1e-6 + 1e-9 * most
    return (
        np.ceil(np.where(low < 0, most, least) * low - margin),
        np.floor(np.where(top < 0, least, most) * top + margin),
    )


def pair_bounds(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score of each pair, by the triangle inequality of angles."""
    closest = np.zeros((len(a.id), len(b.id)))
    widest = np.full((len(a.id), len(b.id)), np.pi)
    for x, y in zip(a.angles.T, b.angles.T, strict=True):
        np.maximum(closest, np.abs(x[:, None] - y[None, :]), out=closest)
        total = x[:, None] + y[None, :]
        np.minimum(widest, np.pi - np.abs(np.pi - total), out=widest)
    product = a.norm[:, None] * b.norm[None, :]
    return interval(closest, widest, product, product)


def tile_bounds(a: Side, tile: Side) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score that each row of ``a`` can have with any row of a tile."""
    first, last = tile.angles.min(0), tile.angles.max(0)
    closest = np.maximum(np.maximum(a.angles - last, first - a.angles), 0).max(1)
    # The angle to the tile's rows is at most x + y, and at most 2 pi - (x + y).
    widest = np.minimum(a.angles + last, 2 * np.pi - a.angles - first).min(1)
    least, most = a.norm * tile.norm.min(), a.norm * tile.norm.max()
    return interval(closest, widest, least, most)


def products(a: Side, b: Side) -> np.ndarray:
    """Exact integer scores of all pairs; doubles hold them where the norms say so."""
    if a.norm.max() * b.norm.max() < 1 << 53:
        return (a.v @ b.v.T).astype(np.int64)
    return a.v.astype(np.int64) @ b.v.T.astype(np.int64)


class Best:
    """The ``k`` first distinct (score, id) of each anchor and window, highest score first."""

    def __init__(self, anchors: int, windows: int, k: int):
        self.score = np.full((anchors, windows, k), LEAST, np.int64)
        self.id = np.full((anchors, windows, k), np.iinfo(np.int64).max, np.int64)

    def take(self, place: int, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[2]
        changed = np.unique(rows)
        rows = np.concatenate([rows, np.repeat(changed, k)])
        score = np.concatenate([score, self.score[changed, place].ravel()])
        ids = np.concatenate([ids, self.id[changed, place].ravel()])
        order = np.lexsort((ids, -score, rows))
        rows, score, ids = rows[order], score[order], ids[order]
        # Empty places repeat and stay.
        same = (rows[1:] == rows[:-1]) & (score[1:] == score[:-1]) & (ids[1:] == ids[:-1])
        kept = np.concatenate([[True], ~same | (score[1:] == LEAST)])
        rows, score, ids = rows[kept], score[kept], ids[kept]
        begin = np.flatnonzero(np.diff(rows, prepend=-1))
        sizes = np.diff(np.append(begin, len(rows)))
        rank = np.arange(len(rows)) - np.repeat(begin, sizes)
        first = rank < k
        self.score[rows[first], place, rank[first]] = score[first]
        self.id[rows[first], place, rank[first]] = ids[first]


def tiles(rows: Side) -> Iterator[Side]:
    """``rows`` in tiles of one label and near one direction each, as far as that goes."""
    near = rows.angles.argmin(1)
    order = np.lexsort((rows.angles.min(1), near, rows.label))
    for at in range(0, len(order), TILE):
        yield rows.of(order[at : at + TILE])


def search(
    anchors: Side, rows: Side, low: np.ndarray, high: np.ndarray, same: bool, k: int
) -> Best:
    """The first ``k`` rows of each anchor and window, of its own label or of others."""
    best = Best(len(anchors.id), low.shape[1], k)
    for tile in tiles(rows):
        bar = np.maximum(low, best.score[:, :, -1])
        least, most = tile_bounds(anchors, tile)
        open_windows = (most[:, None] >= bar) & (least[:, None] <= high) & (bar <= high)
        mine = np.isin(anchors.label, tile.label) if same else True
        live = np.flatnonzero(open_windows.any(1) & mine)
        if not len(live):
            continue
        some = anchors.of(live)
        bar, top = bar[live], high[live]
        allowed = (some.label[:, None] == tile.label[None, :]) == same
        own_row, own_column = np.nonzero(some.id[:, None] == tile.id[None, :])
        equal = (some.v[own_row] == tile.v[own_column]).all(1)
        allowed[own_row[equal], own_column[equal]] = False
        least, most = pair_bounds(some, tile)
        wanted = np.zeros_like(allowed)
        for place in range(bar.shape[1]):
            wanted |= (most >= bar[:, place, None]) & (least <= top[:, place, None])
        wanted &= allowed
        left, right = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
        if not len(left):
            continue
        wanted = wanted[np.ix_(left, right)]
        score = products(some.of(left), tile.of(right))
        ids = tile.id[right]
        for place in range(bar.shape[1]):
            least_here = bar[left, place, None]
            inside = wanted & (score >= least_here) & (score <= top[left, place, None])
            # Of equal scores only smaller ids can still come in.
            last = best.id[live[left], place, -1]
            inside &= (score > best.score[live[left], place, -1, None]) | (ids < last[:, None])
            i, j = np.nonzero(inside)
            if len(i):
                best.take(place, live[left[i]], score[i, j], ids[j])
    return best


def best_windows(bars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.full((len(bars), 1), LEAST + 1), np.full((len(bars), 1), MOST)


def in_cells(
    rows: DataFrame, anchors: DataFrame, windows: Windows, same: bool, k: int
) -> DataFrame:
    """(key, place, rank, id, score): the first ``k`` rows for each window of each anchor."""
    size = F.sum(F.size("v") * 4 + F.size("angles") * 4 + 32)
    (count, row_bytes), = rows.agg(F.count("*"), size).collect()
    (anchor_bytes,), = anchors.agg(size).collect()
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, -(-(row_bytes or 0) // ROW_BYTES), min(tasks, count // CELL_ROWS))
    down = max(1, -(-(anchor_bytes or 0) // ANCHOR_BYTES))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(to: int) -> Column:
        return F.pmod("at", F.lit(to)).cast("int")

    left = rows.withColumn("c", dealt(across)).withColumn("r", each(down))
    right = anchors.withColumn("r", dealt(down)).withColumn("c", each(across))
    # Anchors come from the rows, so their columns take new names for the pairing.
    right = right.toDF(*right.columns)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        by_dims = {dims: side for dims, _, side in sides(left)} if len(left) else {}
        out = [[], [], [], []]
        for dims, mine, side in sides(right) if len(right) else ():
            if dims not in by_dims:
                continue
            lists = [right.column("bars")[i].as_py() for i in mine.tolist()]
            key = right.column("key").to_numpy()[mine]
            for n in sorted({len(x) for x in lists}):
                own = np.array([i for i, x in enumerate(lists) if len(x) == n])
                bars = np.array([lists[i] for i in own], np.int64).reshape(len(own), n)
                best = search(side.of(own), by_dims[dims], *windows(bars), same, k)
                at, place, rank = np.nonzero(best.score > LEAST)
                for column, values in zip(
                    out,
                    (key[own][at], place, best.id[at, place, rank], best.score[at, place, rank]),
                    strict=True,
                ):
                    column.append(values)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["key", "place", "id", "score"],
        )

    cells = left.groupBy("r", "c").cogroup(right.groupBy("r", "c")).applyInArrow(run, FOUND)
    # A row that repeats has one rank, so it counts once.
    order = Window.partitionBy("key", "place").orderBy(F.desc("score"), "id")
    ranked = cells.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k)
    return ranked.dropDuplicates(["key", "place", "rank"])


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
    vector_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    A component x becomes floor(scale * x); a score is the integer inner product, higher ones
    first, ties by the smaller id. Anchors are the rows where ``anchor`` holds, their positives
    the first ``positives`` other rows of their label. Each positive's negatives are the first
    ``negatives`` rows of other labels that score no more than it and at least ``percent`` % of that,
    numbered by ``rank``; a positive below zero has none.

    Rows without an id, label or vector, with a null or non-finite component, or with an
    integer vector of length 2 ** 28 or more take no part; vectors of unlike lengths never
    meet. Repeated rows are one row: an id counts once at a score, and is never its own
    positive; other vectors under an anchor's id are rows like others. Empty tables give no
    rows; other columns are not read.
    """
    found = usable(vectors, anchor, scale, vector_id, label, vector)
    rows = cut_lineage(with_angles(found, directions(found)))
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    asked = cut_lineage(rows.filter("asked").drop("at").dropDuplicates(["id", "label", "v"]))
    asked = asked.withColumn("at", F.monotonically_increasing_id()).withColumn("key", F.col("at"))

    def near(bars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return -((-percent * bars) // 100), bars

    none = F.array().cast("array<long>")
    first = in_cells(rows, asked.withColumn("bars", none), best_windows, True, positives)
    first = cut_lineage(first.select("key", (F.col("rank") - 1).alias("place"), "id", "score"))
    bars = first.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("b"))
    again = asked.join(bars.select("key", F.col("b.score").alias("bars")), "key")
    second = in_cells(rows, again, near, False, negatives)
    pairs = first.join(asked.select("key", F.col("id").alias("anchor_id")), "key").select(
        "key",
        "place",
        "anchor_id",
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return second.join(pairs, ["key", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
