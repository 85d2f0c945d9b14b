"""Edges, degrees and centrality of the interaction graph.

An undirected graph is a table ``(src, dst, ...)`` with ``src <= dst``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.functions.metrics import as_int
from chatterscope.functions.text import extract_mentions, repost_target
from chatterscope.operators.ranking import count_by, explode_names, top
from chatterscope.plans.joins import salted_join
from chatterscope.plans.lineage import cut_lineage

PRUNE_DEGREE = 2
NODE_SIZE = 5.0
NODE_SIZE_RANGE = 20.0


def by_sentiment(scored: DataFrame, choice: str = "all") -> DataFrame:
    """Posts labelled ``positive`` or ``negative``; ``all`` keeps every post."""
    if choice == "all":
        return scored
    return scored.filter(F.col("sentiment") == choice.capitalize())


def interactions(posts: DataFrame) -> DataFrame:
    """(post_id, src, dst, kind, first): who a post mentions or reposts, self left out.

    A repost names its author twice, as mention and as repost. ``first`` marks the first
    time a post names a user, so posts per pair can be summed without a distinct.
    """
    def to(target: Column, kind: str | None, first: int) -> Column:
        return F.struct(
            target.alias("target"),
            F.lit(kind).cast("string").alias("kind"),
            F.lit(first).alias("first"),
        )

    named = F.concat(
        F.transform("mentions", lambda m: to(m, "mention", 0)),
        F.filter(F.array(to(F.col("reposted"), "retweet", 0)), lambda t: t["target"].isNotNull()),
        F.transform(F.array_distinct("mentions"), lambda m: to(m, None, 1)),
    )
    named_by = posts.filter(F.col("username").isNotNull() & (F.col("username") != "")).select(
        "post_id",
        "username",
        extract_mentions(F.col("text")).alias("mentions"),
        repost_target(F.col("text")).alias("reposted"),
    )
    rows = (
        named_by.select("post_id", "username", F.explode_outer(named).alias("to"))
        .select("post_id", "username", "to.*")
        .filter((F.col("target") != "") & (F.col("target") != F.col("username")))
    )
    return rows.select(
        "post_id",
        F.least("username", "target").alias("src"),
        F.greatest("username", "target").alias("dst"),
        "kind",
        "first",
    )


def interaction_edges(posts: DataFrame) -> DataFrame:
    """(src, dst, weight, n_posts, types, title): one row per pair of users.

    A pair may hold a third of all posts, so its posts are counted, not gathered; the
    posts themselves are rows of ``edge_posts``.
    """
    kind = F.col("kind")
    pairs = (
        interactions(posts)
        .groupBy("src", "dst")
        .agg(
            F.count("kind").alias("weight"),
            F.sum("first").alias("n_posts"),
            F.max(kind == "mention").alias("mentioned"),
            F.max(kind == "retweet").alias("reposted"),
        )
    )
    types = F.concat_ws(
        ", ", F.when(F.col("mentioned"), "mention"), F.when(F.col("reposted"), "retweet")
    )
    return pairs.withColumn("types", types).select(
        "src",
        "dst",
        "weight",
        "n_posts",
        "types",
        F.format_string("%s (%d times)", "types", "weight").alias("title"),
    )


def edge_posts(posts: DataFrame) -> DataFrame:
    """(src, dst, post_id): the posts behind each edge, one row per post as ``n_posts`` counts
    them; a post that the table holds twice counts twice in both."""
    return interactions(posts).filter(F.col("first") == 1).select("src", "dst", "post_id")


def engagement_value_edges(posts: DataFrame) -> DataFrame:
    """Distinct links between an author id and each of its positive metric values."""
    metrics = ["retweets", "replies", "likes"]
    values = posts.select(
        F.col("author_id").alias("author"), *[as_int(m).cast("bigint").alias(m) for m in metrics]
    ).unpivot(["author"], metrics, "metric", "value")
    return (
        values.filter((F.col("value") > 0) & F.col("author").isNotNull())
        .select(F.least("author", "value").alias("src"), F.greatest("author", "value").alias("dst"))
        .distinct()
    )


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree); a self-loop counts twice."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("degree"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    return _with_centrality(degrees(edges))


def _with_centrality(nodes: DataFrame) -> DataFrame:
    """Share of the other vertices each one is linked to; the degrees are kept, being read twice."""
    nodes = cut_lineage(nodes)
    others = nodes.agg(F.count("*") - 1).scalar()
    share = F.col("degree") / F.nullif(others, F.lit(0))
    return nodes.withColumn("centrality", F.round(F.coalesce(share, F.lit(1.0)), 9))


def top_influencers(edges: DataFrame, k: int = 10) -> DataFrame:
    return top(degree_centrality(edges), "centrality", "id", k=k)


def influencer_flags(edges: DataFrame, k: int = 10) -> DataFrame:
    """Every vertex with a flag for the k most central ones."""
    nodes = degree_centrality(edges)
    best = top(nodes, "centrality", "id", k=k).select("id", F.lit(True).alias("is_top"))
    flagged = nodes.join(F.broadcast(best), "id", "left")
    return flagged.withColumn("is_top", F.coalesce("is_top", F.lit(False)))


def graph_stats(edges: DataFrame) -> DataFrame:
    """One row: vertices, edges. The edges are read twice, so pass kept ones."""
    vertices = degrees(edges).agg(F.count("*")).scalar()
    return edges.agg(vertices.alias("vertices"), F.count("*").alias("edges"))


def kept_vertices(edges: DataFrame, min_degree: int) -> DataFrame:
    """Vertices of at least ``min_degree`` links: one pruning pass, alike at every size."""
    return degrees(edges).filter(F.col("degree") >= min_degree).select("id")


def prune(edges: DataFrame, min_degree: int = PRUNE_DEGREE) -> DataFrame:
    """Edges between vertices of at least ``min_degree`` links; those edges are read several
    times, so pass kept ones."""
    return between(edges, kept_vertices(edges, min_degree))


def between(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges with both ends in ``kept``; edges of a hub are salted."""
    left = edges
    for end in ("src", "dst"):
        left = salted_join(left, kept.withColumnRenamed("id", end), end, "left_semi")
    return left.select(*edges.columns)


def interaction_nodes(edges: DataFrame, min_degree: int = PRUNE_DEGREE) -> DataFrame:
    """(id, degree, centrality, size, title) of the pruned graph, isolated vertices too."""
    kept = cut_lineage(kept_vertices(edges, min_degree))
    left = kept.join(degrees(between(edges, kept)), "id", "left")
    nodes = _with_centrality(left.withColumn("degree", F.coalesce("degree", F.lit(0))))
    return nodes.select(
        "id",
        "degree",
        "centrality",
        F.round(NODE_SIZE + NODE_SIZE_RANGE * F.col("centrality"), 6).alias("size"),
        F.concat(F.lit("User: "), "id").alias("title"),
    )


def top_mentioned(posts: DataFrame, k: int = 10) -> DataFrame:
    names = explode_names(posts, extract_mentions(F.col("text")), "username")
    return top(count_by(names, "username", output="mentions"), "mentions", "username", k=k)


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
