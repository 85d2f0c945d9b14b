"""Connected components and label propagation as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from chatterscope.functions.metrics import as_number, row_total
from chatterscope.operators.graph import vertices as vertices_of
from chatterscope.plans.joins import SALT, hot_keys, salt_rows, salted_join, spread_rows
from chatterscope.plans.lineage import cut_lineage
from chatterscope.schema import CHART_METRICS


def connected_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(id, component), the component being its smallest vertex id.

    Alternating large-star and small-star steps (Kiveris et al. 2014) over links
    (child, parent) with parent < child: the number of rounds grows with the logarithm of
    the graph, not with its diameter. A round's hubs are salted.
    """
    vertices = vertices_of(edges) if vertices is None else vertices
    links = cut_lineage(
        edges.filter(F.col("src") != F.col("dst"))
        .select(
            F.greatest("src", "dst").alias("child"), F.least("src", "dst").alias("parent")
        )
        .distinct()
    )
    while True:
        state = _state(links)
        if not state["unsettled"]:
            break
        size = state["links"]
        links = cut_lineage(_small_star(_large_star(links, size), size))
    roots = links.select(F.col("child").alias("id"), F.col("parent").alias("component"))
    return vertices.join(roots, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )


def _large_star(links: DataFrame, size: int) -> DataFrame:
    """Hang every larger neighbour of a vertex under its smallest neighbour."""
    as_child = links.groupBy(F.col("child").alias("parent")).agg(F.min("parent").alias("smallest"))
    sizes = links.groupBy("parent").agg(F.count("*").alias("n"))
    smallest = sizes.join(as_child, "parent", "left").select(
        "parent", F.coalesce("smallest", "parent").alias("root")
    )
    moved = salted_join(
        links, smallest, "parent", by=["child"], counts=sizes, at_most=size
    )
    return moved.select("child", F.col("root").alias("parent")).distinct()


def _small_star(links: DataFrame, size: int) -> DataFrame:
    """Hang a vertex and its smaller neighbours under the smallest of them."""
    smallest = links.groupBy("child").agg(F.min("parent").alias("root"), F.count("*").alias("n"))
    moved = salted_join(
        links,
        smallest.select("child", "root"),
        "child",
        by=["parent"],
        counts=smallest.select("child", "n"),
        at_most=size,
    )
    # Each link carries its child along, so one pass over the join yields both kinds of link.
    both = moved.select(
        F.explode(
            F.array(
                F.struct(F.col("parent").alias("child"), F.col("root").alias("parent")),
                F.struct(F.col("child").alias("child"), F.col("root").alias("parent")),
            )
        ).alias("link")
    ).select("link.*")
    return both.filter(F.col("child") != F.col("parent")).distinct()


def _state(links: DataFrame) -> Row:
    """Number of links, and of vertices that have two parents or are child and parent.

    Without such a vertex the links form stars around the smallest members: done.
    """
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("child").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("parent").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            )
        ).alias("end")
    ).select("end.*")
    per_vertex = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_vertex.agg(
        F.coalesce(F.sum("up"), F.lit(0)).alias("links"),
        F.count_if(F.col("up") + F.col("down") * F.least("up", F.lit(1)) > 1).alias("unsettled"),
    ).first()


def label_propagation(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, community): each round a vertex takes the label of largest total edge weight
    among its neighbours, the smaller label on a tie (all vertices at once).

    Without ``rounds`` it goes on until the labels repeat: either they stay, or two states
    take turns, as on a graph of two sides; then each vertex has the smaller of its two. With
    ``rounds`` it ends after so many, settled or not. Hubs are found once and their arcs
    salted once; votes are summed before each shuffle.
    """
    simple = edges.filter(F.col("src") != F.col("dst"))
    arcs = simple.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("voter"), F.col("dst").alias("id"), "weight"),
                F.struct(F.col("dst").alias("voter"), F.col("src").alias("id"), "weight"),
            )
        ).alias("arc")
    ).select("arc.*")
    sizes = arcs.groupBy("voter").agg(F.count("*").alias("n"))
    hot = hot_keys(sizes, "voter")
    if hot:
        arcs = salt_rows(arcs, "voter", hot, by=["id"])
    arcs = cut_lineage(arcs)
    # The label, and the one before it.
    labels = cut_lineage(
        vertices_of(edges).select("id", F.col("id").alias("label"), F.col("id").alias("last"))
    )
    done = 0
    while rounds is None or done < rounds:
        cast = labels.select(F.col("id").alias("voter"), "label")
        if hot:
            cast = spread_rows(cast, "voter", hot)
        votes = (
            arcs.join(cast, ["voter", SALT] if hot else "voter")
            .groupBy("id", "label")
            .agg(F.sum("weight").alias("votes"))
        )
        chosen = votes.groupBy("id").agg(
            F.min(F.struct((-F.col("votes")).alias("rank"), "label"))["label"].alias("chosen")
        )
        moved = cut_lineage(
            labels.join(chosen, "id", "left").select(
                "id",
                F.coalesce("chosen", "label").alias("label"),
                F.col("label").alias("last"),
                F.col("last").alias("older"),
            )
        )
        labels = moved.drop("older")
        done += 1
        if rounds is None:
            state = moved.agg(
                F.count_if(F.col("label") != F.col("last")).alias("changed"),
                F.count_if(F.col("label") != F.col("older")).alias("unlike_older"),
            ).first()
            if not state["changed"]:
                break
            if done > 1 and not state["unlike_older"]:
                return labels.select("id", F.least("label", "last").alias("community"))
    return labels.select("id", F.col("label").alias("community"))


def community_summary(communities: DataFrame, posts: DataFrame) -> DataFrame:
    """(community, size, posts, avg_engagement), posts being those its members wrote."""
    engagement = row_total([as_number(m) for m in CHART_METRICS])
    per_user = (
        posts.filter(F.col("username").isNotNull())
        .groupBy(F.col("username").alias("id"))
        .agg(F.sum(engagement).alias("engagement"), F.count("*").alias("posts"))
    )
    members = communities.join(per_user, "id", "left")
    totals = members.groupBy("community").agg(
        F.count("*").alias("size"),
        F.coalesce(F.sum("posts"), F.lit(0)).alias("posts"),
        F.coalesce(F.sum("engagement"), F.lit(0.0)).alias("engagement"),
    )
    mean = F.coalesce(F.col("engagement") / F.nullif("posts", F.lit(0)), F.lit(0.0))
    return totals.select("community", "size", "posts", F.round(mean, 6).alias("avg_engagement"))
