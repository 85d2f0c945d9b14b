"""Community split by edge betweenness (Girvan and Newman 2002).

Shortest paths are searched from a bounded batch of vertices at a time, and each batch's flow is
added to running sums by edge. Edges of checked size (``ARRAY_EDGES``) go to all tasks as arrays,
and each task follows the paths of its share of the vertices; beyond that a level of paths is a
join, and the rows held are those of a batch, times the vertices. Components are followed on their
own until each falls apart, small ones in a task each. The work stays vertices times edges for
each removal in a component, so the method is for graphs of interest;
``components.label_propagation`` is the cheap way for a whole network.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.operators.components import connected_components
from chatterscope.operators.graph import vertices as vertices_of
from chatterscope.plans.joins import SALT, hot_keys, salt_rows, salted_join, spread_rows
from chatterscope.plans.lineage import cut_lineage
from chatterscope.plans.numbering import numbered


ROUNDS_PER_CUT = 10
# Vertices from which paths are searched at a time.
SOURCES = 2_000
# Edges, and bytes of their names, up to which they are sent to all tasks.
ARRAY_EDGES = 1_000_000
ARRAY_BYTES = 64 << 20
# Arcs times sources that a task holds at a time, and parts the sources are dealt to at most.
SLAB = 1 << 20
PARTS = 256


def simple_edges(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()


class Arcs:
    """Both directions of each edge, hubs salted, for repeated expansion of a frontier."""

    def __init__(self, edges: DataFrame) -> None:
        arcs = edges.select(
            F.explode(
                F.array(
                    F.struct(F.col("src").alias("node"), F.col("dst").alias("next")),
                    F.struct(F.col("dst").alias("node"), F.col("src").alias("next")),
                )
            ).alias("arc")
        ).select("arc.*")
        self.hot = hot_keys(arcs.groupBy("node").agg(F.count("*").alias("n")), "node")
        if self.hot:
            arcs = salt_rows(arcs, "node", self.hot, by=["next"])
        self.table = cut_lineage(arcs)
        self.removed = 0

    def remove(self, a, b) -> None:
        node, neighbour = F.col("node"), F.col("next")
        gone = ((node == a) & (neighbour == b)) | ((node == b) & (neighbour == a))
        self.table = self.table.filter(~gone)
        self.removed += 1
        if self.removed % ROUNDS_PER_CUT == 0:
            self.table = cut_lineage(self.table)

    def step(self, frontier: DataFrame) -> DataFrame:
        """Join rows with a ``node`` column to the neighbours (``next``) of that node."""
        if self.hot:
            return spread_rows(frontier, "node", self.hot).join(self.table, ["node", SALT])
        return frontier.join(self.table, "node")

    def edges(self) -> DataFrame:
        node, neighbour = F.col("node"), F.col("next")
        return self.table.filter(node < neighbour).select(node.alias("src"), neighbour.alias("dst"))


class ShortestPaths:
    """Breadth-first levels (source, node, paths) from some sources at once.

    With ``goal`` the search ends where that vertex is found.
    """

    def __init__(self, arcs: Arcs, sources: DataFrame, goal: str | None = None) -> None:
        self.arcs, self.found = arcs, False
        start = sources.select(
            F.col("id").alias("source"), F.col("id").alias("node"), F.lit(1.0).alias("paths")
        )
        self.levels = [start]
        while not self.found:
            level = cut_lineage(self._next_level())
            if level.isEmpty():
                break
            self.levels.append(level)
            self.found = goal is not None and not level.filter(F.col("node") == goal).isEmpty()

    def _next_level(self) -> DataFrame:
        reached = (
            self.arcs.step(self.levels[-1])
            .groupBy("source", F.col("next").alias("node"))
            .agg(F.sum("paths").alias("paths"))
        )
        # A neighbour of one level lies on it, on the one before or on the one after.
        seen = self.levels[-1].select("source", "node")
        if len(self.levels) > 1:
            seen = seen.unionAll(self.levels[-2].select("source", "node"))
        return reached.join(seen, ["source", "node"], "left_anti")

    def _flow(self, depth: int, below: DataFrame | None) -> DataFrame:
        """What each arc from level ``depth`` up to the level before it carries, per source."""
        level, credit = self.levels[depth], F.lit(1.0)
        if below is not None:
            level = level.join(below, ["source", "node"], "left")
            credit = 1.0 + F.coalesce("passed", F.lit(0.0))
        share = level.select("source", "node", (credit / F.col("paths")).alias("share"))
        above = self.levels[depth - 1].select(
            "source", F.col("node").alias("next"), F.col("paths").alias("above")
        )
        return (
            self.arcs.step(share)
            .join(above, ["source", "next"])
            .select("source", "node", "next", (F.col("share") * F.col("above")).alias("flow"))
        )

    def flows(self) -> DataFrame | None:
        """(src, dst, flow) by backward accumulation (Brandes 2001); none where no arc is used."""
        carried = []
        below = None
        for depth in range(len(self.levels) - 1, 0, -1):
            flow = self._flow(depth, below)
            carried.append(
                flow.select(
                    F.least("node", "next").alias("src"),
                    F.greatest("node", "next").alias("dst"),
                    "flow",
                )
            )
            if depth > 1:
                below = cut_lineage(
                    flow.groupBy("source", F.col("next").alias("node")).agg(
                        F.sum("flow").alias("passed")
                    )
                )
        return summed(reduce(DataFrame.unionAll, carried)) if carried else None


class Adjacency:
    """The arcs of a network as arrays, in the order of the vertex they leave."""

    def __init__(self, src: pa.Array, dst: pa.Array) -> None:
        ends = pa.concat_arrays([src, dst]).dictionary_encode()
        self.names = ends.dictionary
        self.ends = ends.indices.to_numpy().astype(np.int64).reshape(2, -1)
        tail = self.ends.ravel()
        order = np.argsort(tail, kind="stable")
        self.head = self.ends[::-1].ravel()[order]
        self.edge = order % max(len(src), 1)
        self.begin = np.searchsorted(tail[order], np.arange(len(self.names) + 1))

    def places(self, names: pa.Array) -> np.ndarray:
        """Which vertices the names stand for; those without an edge are left out."""
        return pc.index_in(names, self.names).drop_null().to_numpy().astype(np.int64)

    def levels(self, sources: np.ndarray, seen: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Arcs (from, to, edge) of shortest paths, a level at a time, from all sources at once.

        A vertex reached from the i-th source is i times the number of vertices later in ``seen``.
        """
        n = len(self.names)
        front = np.arange(len(sources)) * n + sources
        seen[front] = True
        turn = np.zeros(len(seen), np.int64)
        while len(front):
            node = front % n
            count = self.begin[node + 1] - self.begin[node]
            arc = np.arange(count.sum()) + np.repeat(self.begin[node] - count.cumsum() + count, count)
            low = np.repeat(front, count)
            high = np.repeat(front - node, count) + self.head[arc]
            new = ~seen[high]
            low, high, arc = low[new], high[new], arc[new]
            seen[high] = True
            yield low, high, self.edge[arc]
            # Each vertex reached, once.
            each = np.arange(len(high))
            turn[high] = each
            front = high[turn[high] == each]

    def flow(self, sources: np.ndarray) -> np.ndarray:
        """What each edge carries, by backward accumulation (Brandes 2001)."""
        size = len(sources) * len(self.names)
        paths, passed = np.zeros(size), np.zeros(size)
        paths[np.arange(len(sources)) * len(self.names) + sources] = 1.0
        levels = []
        for low, high, edge in self.levels(sources, np.zeros(size, bool)):
            np.add.at(paths, high, paths[low])
            levels.append((low, high, edge))
        flow = np.zeros(self.ends.shape[1])
        for low, high, edge in reversed(levels):
            carried = (1.0 + passed[high]) / paths[high] * paths[low]
            np.add.at(passed, low, carried)
            np.add.at(flow, edge, carried)
        return flow

    def reached(self, name, kind: pa.DataType) -> pa.Array:
        """The vertices that a path leads to from the named one, itself included."""
        start = self.places(pa.array([name], kind))
        if not len(start):
            return pa.array([name], kind)
        seen = np.zeros(len(self.names), bool)
        for _ in self.levels(start, seen):
            pass
        return self.names.filter(pa.array(seen))

    def joined(self, ends: np.ndarray) -> bool:
        """If a path leads from the first of two vertices to the second."""
        if len(ends) < 2:
            return False
        seen = np.zeros(len(self.names), bool)
        return any(seen[ends[1]] for _ in self.levels(ends[:1], seen))


def gathered(edges: DataFrame) -> DataFrame | None:
    """One row, the edges as arrays (srcs, dsts); none where they are more than a task should get."""
    length = F.octet_length(F.col("src").cast("string")) + F.octet_length(F.col("dst").cast("string"))
    size = edges.agg(F.count("*").alias("edges"), F.sum(length).alias("bytes")).first()
    if size["edges"] > ARRAY_EDGES or (size["bytes"] or 0) > ARRAY_BYTES:
        return None
    return cut_lineage(edges.agg(F.collect_list("src").alias("srcs"), F.collect_list("dst").alias("dsts")))


def joined(edges: DataFrame, a, b) -> bool:
    """If a path leads from a to b by the edges of a ``gathered`` row."""
    kind = edges.schema["srcs"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            srcs, dsts, ends = (batch.column(i).values for i in range(3))
            network = Adjacency(srcs, dsts)
            found = pa.array([network.joined(network.places(ends))])
            yield pa.RecordBatch.from_arrays([found], ["joined"])

    ends = F.array(F.lit(a), F.lit(b)).cast(kind)
    return edges.select("srcs", "dsts", ends).mapInArrow(run, "joined boolean").first()["joined"]


def gathered_flows(edges: DataFrame, sources: DataFrame, batch: int) -> DataFrame:
    """(src, dst, flow) of paths from ``sources`` by the edges of a ``gathered`` row."""
    kind = edges.schema["srcs"].dataType.elementType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, flow = None, 0.0
        for rows in batches:
            ids, srcs, dsts = rows.columns
            for i in range(rows.num_rows):
                network = network or Adjacency(srcs[i].values, dsts[i].values)
                starts = network.places(ids[i].values)
                some = max(1, min(batch, SLAB // max(1, len(network.head))))
                for first in range(0, len(starts), some):
                    flow = flow + network.flow(starts[first : first + some])
        used = np.flatnonzero(flow)
        if len(used):
            names = [network.names.take(pa.array(end[used])) for end in network.ends]
            yield pa.RecordBatch.from_arrays([*names, pa.array(flow[used])], ["src", "dst", "flow"])

    work = sources.count() * edges.select(F.size("srcs")).first()[0]
    parts = min(PARTS, work // SLAB + 1)
    dealt = sources.select("id", F.pmod(F.xxhash64("id"), F.lit(4 * parts)).alias("part"))
    shares = dealt.repartition(parts, "part").groupBy("part").agg(F.collect_list("id").alias("ids"))
    return shares.crossJoin(F.broadcast(edges)).select("ids", "srcs", "dsts").mapInArrow(
        run, f"src {kind}, dst {kind}, flow double"
    )


def summed(flows: DataFrame) -> DataFrame:
    return flows.groupBy("src", "dst").agg(F.sum("flow").alias("flow"))


def betweenness(
    arcs: Arcs, sources: DataFrame, batch: int = SOURCES, edges: DataFrame | None = None
) -> DataFrame | None:
    """(src, dst, betweenness) of the arcs that paths from ``sources`` use, a batch at a time.

    The sources have to be whole components: every pair is then counted from both its ends.
    ``edges`` is their ``gathered`` row, if they have one.
    """
    half = F.round(F.col("flow") / 2, 9)
    if edges is not None:
        total = cut_lineage(summed(gathered_flows(edges, sources, batch)))
        return None if total.isEmpty() else total.select("src", "dst", half.alias("betweenness"))
    numbers = cut_lineage(numbered(sources, "id", "number"))
    total = None
    for first in range(0, numbers.count(), batch):
        some = numbers.filter((F.col("number") >= first) & (F.col("number") < first + batch))
        flows = ShortestPaths(arcs, some.select("id")).flows()
        if flows is not None:
            total = cut_lineage(flows if total is None else summed(total.unionAll(flows)))
    return None if total is None else total.select("src", "dst", half.alias("betweenness"))


def edge_betweenness(edges: DataFrame, batch: int = SOURCES) -> DataFrame:
    """(src, dst, betweenness) of a graph's edges, self-loops left out."""
    simple = simple_edges(edges)
    found = betweenness(Arcs(simple), vertices_of(simple), batch, gathered(simple))
    return simple.withColumn("betweenness", F.lit(0.0)) if found is None else found


# Vertices times edges up to which a component is followed in one task.
SMALL_COMPONENT = 1 << 24
# Edges taken out of each small component at first; four times as many in each next turn.
FIRST_TURN = 8


class Removed:
    """The order in which edges go: highest betweenness first, the smallest (src, dst) on a tie.

    Components do not concern each other, so the edges of all go in turns: a component's next edge
    waits until all others' next edges are behind it. The component that falls apart first is
    hence the one whose worst edge up to that goes before the worst edge of every other.
    """

    def __init__(self, row) -> None:
        self.score, self.ends = row["betweenness"], (row["src"], row["dst"])

    def before(self, other: Removed) -> bool:
        return (-self.score, self.ends) < (-other.score, other.ends)

    def worse(self, other: Removed | None) -> Removed:
        return self if other is None or other.before(self) else other


def _fallen(
    src: pa.Array, dst: pa.Array, most: int, bar: Removed | None
) -> tuple[Removed, pa.Array, pa.Array] | tuple[Removed, None, None]:
    """(worst edge removed, the two parts) of a connected graph. No parts if it holds after ``most``
    edges, or once an edge goes that ``bar`` goes before."""
    network = Adjacency(src, dst)
    # Edges that are there twice are one pair and go together.
    _, pair = np.unique(network.ends[0] * len(network.names) + network.ends[1], return_inverse=True)
    everyone, worst = network.names, None
    for _ in range(most):
        flow = np.zeros(len(src))
        some = max(1, SLAB // max(1, len(network.head)))
        for first in range(0, len(network.names), some):
            flow += network.flow(np.arange(first, min(first + some, len(network.names))))
        scores = np.round(np.bincount(pair, flow) / 2, 9)[pair]
        tied = np.flatnonzero(scores == scores.max())
        at = min(tied, key=lambda i: (src[i].as_py(), dst[i].as_py()))
        best = Removed({"betweenness": float(scores[at]), "src": src[at].as_py(), "dst": dst[at].as_py()})
        worst = best.worse(worst)
        if bar is not None and bar.before(worst):
            break
        left = pa.array(pair != pair[at])
        src, dst, pair = src.filter(left), dst.filter(left), pair[left.to_numpy(zero_copy_only=False)]
        pair = np.unique(pair, return_inverse=True)[1]
        network = Adjacency(src, dst)
        here = network.reached(best.ends[0], everyone.type)
        if not pc.is_in(pa.array([best.ends[1]], everyone.type), value_set=here)[0].as_py():
            return worst, here, everyone.filter(pc.invert(pc.is_in(everyone, value_set=here)))
    return worst, None, None


def fallen(edges: DataFrame, most: int, bar: Removed | None) -> DataFrame:
    """(component, betweenness, src, dst, here, there) of (component, src, dst), a component in a
    task: the worst edge removed, and the two parts if it fell apart, see ``_fallen``."""
    kind = edges.schema["src"].dataType.simpleString()

    def run(key: tuple, table: pa.Table) -> pa.Table:
        src, dst = (table[c].combine_chunks() for c in ("src", "dst"))
        worst, here, there = _fallen(src, dst, most, bar)
        named = zip(("component", "src", "dst"), (key[0].as_py(), *worst.ends), strict=True)
        columns = {c: pa.array([end], src.type) for c, end in named} | {"betweenness": [worst.score]}
        for c, part in (("here", here), ("there", there)):
            columns[c] = pa.array([part and part.to_pylist()], pa.list_(src.type))
        order = ["component", "betweenness", "src", "dst", "here", "there"]
        return pa.table({c: columns[c] for c in order})

    return edges.groupBy("component").applyInArrow(
        run,
        f"component {kind}, betweenness double, src {kind}, dst {kind}, "
        f"here array<{kind}>, there array<{kind}>",
    )


def fallen_large(
    edges: DataFrame, vertices: DataFrame, batch: int, bar: Removed | None
) -> tuple[Removed, DataFrame] | None:
    """(worst edge removed, components of the parts) of one large component, its paths searched by
    all tasks; none as soon as an edge goes that ``bar`` goes before."""
    arcs, worst = Arcs(edges), None
    scores = betweenness(arcs, vertices, batch, gathered(arcs.edges()))
    while scores is not None:
        # One row reaches the driver per round: the edge to remove.
        best = Removed(scores.orderBy(F.desc("betweenness"), "src", "dst").first())
        worst, (a, b) = best.worse(worst), best.ends
        if bar is not None and bar.before(worst):
            return None
        arcs.remove(a, b)
        left = gathered(arcs.edges())
        if left is None:
            linked = ShortestPaths(arcs, vertices.filter(F.col("id") == a), goal=b).found
        else:
            linked = joined(left, a, b)
        if not linked:
            return worst, connected_components(arcs.edges(), vertices)
        scores = betweenness(arcs, vertices, batch, left)
    return None


def split_communities(edges: DataFrame, batch: int = SOURCES) -> DataFrame:
    """(id, community): components once the edges of highest betweenness are taken out.

    One edge goes at a time, the smallest (src, dst) on a tie, until one component falls
    into two. Components are followed on their own, see ``Removed``: small ones in a task each,
    large ones one after the other. Communities are numbered from 1 by their smallest member. A
    graph without edges is returned as single vertices.
    """
    vertices = cut_lineage(vertices_of(edges))
    simple = Arcs(simple_edges(edges)).edges()
    parts = cut_lineage(connected_components(simple, vertices))
    owned = cut_lineage(salted_join(simple, parts.withColumnRenamed("id", "src"), "src", by=["dst"]))
    lines = owned.groupBy("component").agg(F.count("*").alias("edges"))
    sizes = parts.groupBy("component").agg(F.count("*").alias("vertices")).join(lines, "component")
    sizes = cut_lineage(sizes)
    work = F.col("vertices") * F.col("edges")
    small = owned.join(sizes.filter(work <= SMALL_COMPONENT), "component", "left_semi")
    row, first, most = None, None, FIRST_TURN
    while True:
        state = cut_lineage(fallen(small, most, first))
        fell = state.filter(F.col("here").isNotNull()).orderBy(F.desc("betweenness"), "src", "dst").first()
        if fell is not None and (first is None or Removed(fell).before(first)):
            row, first = fell, Removed(fell)
        # Those that hold, and may still be the first to fall.
        open_ = state.filter(F.col("here").isNull())
        if first is not None:
            score, ends = F.col("betweenness"), F.struct("src", "dst")
            bar = F.struct(*[F.lit(e).cast(simple.schema["src"].dataType).alias(c) for c, e in zip(("src", "dst"), first.ends, strict=True)])
            open_ = open_.filter((score > first.score) | ((score == first.score) & (ends < bar)))
        if open_.isEmpty():
            break
        small, most = small.join(open_.select("component"), "component", "left_semi"), 4 * most
    found = row and _parted(parts, row)
    # So few that their names fit the driver: each has over four thousand edges.
    for large in sizes.filter(work > SMALL_COMPONENT).orderBy(F.desc("edges")).collect():
        own = F.col("component") == large["component"]
        fell = fallen_large(
            owned.filter(own).select("src", "dst"), parts.filter(own).select("id"), batch, first
        )
        if fell is not None:
            first, found = fell[0], parts.filter(~own).unionByName(fell[1].select(*parts.columns))
    return number_communities(parts if found is None else found)


def _parted(parts: DataFrame, row) -> DataFrame:
    """``parts`` with the component of a row of ``fallen`` as two, named after their least ids."""
    kind = parts.schema["component"].dataType
    here, there = (F.lit(min(row[c])).cast(kind) for c in ("here", "there"))
    inside = F.array_contains(F.array(*[F.lit(i).cast(kind) for i in row["here"]]), F.col("id"))
    name = F.when(inside, here).otherwise(there)
    return parts.withColumn(
        "component", F.when(F.col("component") == row["component"], name).otherwise(F.col("component"))
    )


def number_communities(components: DataFrame) -> DataFrame:
    """(id, community): components numbered from 1 in the order of their names."""
    numbers = numbered(components, "component", "community", first=1)
    return salted_join(components, numbers, "component", by=["id"]).select("id", "community")
