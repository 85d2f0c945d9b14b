import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from chatterscope.checks.queries import QUERIES
from chatterscope.operators import communities, components, engagement, graph
from chatterscope.plans import joins

SAMPLE = [
    (1, "2", "0", "5"), (2, "1", "2", "0"), (3, "0", "3", "1"), (4, "0", "0", "10"),
    (5, "3", "0", "4"), (6, "0", "1", "0"), (7, "0", "0", "2"), (8, "4", "0", "3"),
    (9, "2", "1", "5"), (10, "1", "0", "8"),
]


@pytest.fixture(scope="module")
def sample(spark):
    posts = spark.createDataFrame(
        SAMPLE, "author_id long, retweets string, replies string, likes string"
    )
    return graph.engagement_value_edges(posts).cache()


def edge_table(spark, edges, weight=False):
    rows = [(min(a, b), max(a, b), 1) for a, b in edges]
    return spark.createDataFrame(rows, "src long, dst long, weight long")


def random_edges(seed, n, m):
    rng = random.Random(seed)
    return sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)})


def neighbours(edges):
    found = defaultdict(set)
    for a, b in edges:
        found[a].add(b)
        found[b].add(a)
    return found


def brute_betweenness(edges):
    """Share of shortest paths over each edge, by listing them."""
    near = neighbours(edges)
    result = {e: 0.0 for e in edges}
    nodes = sorted(near)
    for s in nodes:
        distance, order = {s: 0}, deque([s])
        while order:
            v = order.popleft()
            for w in near[v]:
                if w not in distance:
                    distance[w] = distance[v] + 1
                    order.append(w)
        for t in nodes:
            if t <= s or t not in distance:
                continue
            paths = [[t]]
            while paths[0][-1] != s:
                paths = [
                    p + [v] for p in paths for v in near[p[-1]] if distance[v] == distance[p[-1]] - 1
                ]
            for p in paths:
                for a, b in zip(p, p[1:]):
                    result[min(a, b), max(a, b)] += 1 / len(paths)
    return result


def brute_components(edges):
    near, root = neighbours(edges), {}
    for v in sorted(near):
        stack = [v] if v not in root else []
        while stack:
            u = stack.pop()
            if u not in root:
                root[u] = v
                stack.extend(near[u])
    return root


def brute_split(edges):
    left = list(edges)
    count = len(set(brute_components(left).values()))
    while left:
        scores = brute_betweenness(left)
        left.remove(min(left, key=lambda e: (-round(scores[e], 9), e)))
        roots = brute_components(left)
        for a, b in edges:
            roots.setdefault(a, a)
            roots.setdefault(b, b)
        if len(set(roots.values())) > count:
            break
    return roots


def test_sample_edges_and_degrees(sample):
    assert sample.count() == 17
    degrees = {r["id"]: r["degree"] for r in graph.degrees(sample).collect()}
    assert degrees == {1: 6, 2: 5, 3: 5, 5: 4, 4: 3, 8: 3, 9: 3, 10: 3, 6: 1, 7: 1}
    assert sum(degrees.values()) == 2 * sample.count()
    centrality = {r["id"]: r["centrality"] for r in graph.degree_centrality(sample).collect()}
    assert centrality == pytest.approx({i: d / 9 for i, d in degrees.items()}, abs=1e-8)
    assert [r["id"] for r in graph.top_influencers(sample, 3).collect()] == [1, 2, 3]
    flags = {r["id"] for r in graph.influencer_flags(sample, 3).filter("is_top").collect()}
    assert flags == {1, 2, 3}


def test_sample_components_and_communities(sample):
    assert {r["component"] for r in components.connected_components(sample).collect()} == {1}
    scores = {
        (r["src"], r["dst"]): r["betweenness"] for r in communities.edge_betweenness(sample).collect()
    }
    assert max(scores, key=scores.get) == (1, 2)
    assert scores[1, 2] == pytest.approx(12.3333, abs=1e-4)
    split = defaultdict(set)
    for r in communities.split_communities(sample).collect():
        split[r["community"]].add(r["id"])
    assert split == {1: {1, 3, 4, 5, 6, 8, 9, 10}, 2: {2, 7}}


@pytest.mark.parametrize("hot", [False, True])
def test_betweenness_by_brute_force(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(joins, "HOT_FLOOR", 0)
    edges = random_edges(3, 14, 22)
    got = {
        (r["src"], r["dst"]): r["betweenness"]
        for r in communities.edge_betweenness(edge_table(spark, edges)).collect()
    }
    assert got == pytest.approx(brute_betweenness(edges), abs=1e-6)


def test_split_by_brute_force(spark):
    edges = random_edges(5, 10, 14)
    got = {r["id"]: r["community"] for r in communities.split_communities(edge_table(spark, edges)).collect()}
    expected = brute_split(edges)
    numbers = {root: i + 1 for i, root in enumerate(sorted(set(expected.values())))}
    assert got == {v: numbers[root] for v, root in expected.items()}


def test_split_in_small_batches_over_several_components(spark):
    # Two components: the second holds the bridge that goes last.
    edges = [(0, 1), (0, 2), (1, 2), (2, 3), (0, 3), (1, 3)]
    edges += [(a + 10, b + 10) for a, b in random_edges(5, 10, 14)]
    table = edge_table(spark, edges)
    scores = {(r["src"], r["dst"]): r["betweenness"] for r in communities.edge_betweenness(table, batch=3).collect()}
    assert scores == pytest.approx(brute_betweenness(edges), abs=1e-6)
    got = {r["id"]: r["community"] for r in communities.split_communities(table, batch=5).collect()}
    expected = brute_split(edges)
    numbers = {root: i + 1 for i, root in enumerate(sorted(set(expected.values())))}
    assert got == {v: numbers[root] for v, root in expected.items()}


def test_query_splits_the_network_of_the_tables(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["id"]: r["community"] for r in QUERIES["community_split"](spark, folder).collect()}
    rows = QUERIES["interaction_edges"](spark, folder).select("src", "dst").collect()
    edges = sorted({(r["src"], r["dst"]) for r in rows if r["src"] != r["dst"]})
    expected = brute_split(edges)
    numbers = {root: i + 1 for i, root in enumerate(sorted(set(expected.values())))}
    assert got == {v: numbers[root] for v, root in expected.items()}


@pytest.mark.parametrize("hot", [False, True])
def test_components_by_brute_force(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(joins, "HOT_FLOOR", 0)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(200, i) for i in range(201, 260)]
    edges = random_edges(7, 60, 40) + chain + star + [(5, 5)]
    got = {r["id"]: r["component"] for r in components.connected_components(edge_table(spark, edges)).collect()}
    assert got == brute_components(edges)


@pytest.mark.parametrize("hot", [False, True])
def test_label_propagation_by_brute_force(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(joins, "HOT_FLOOR", 0)
    edges = random_edges(11, 20, 35)
    near = neighbours(edges)
    labels = {v: v for v in near}
    for _ in range(3):
        votes = {}
        for v in near:
            count = defaultdict(int)
            for u in near[v]:
                count[labels[u]] += 1
            votes[v] = min(count, key=lambda label: (-count[label], label))
        labels = votes
    got = {r["id"]: r["community"] for r in components.label_propagation(edge_table(spark, edges), 3).collect()}
    assert got == labels


def test_prune_is_one_pass(spark):
    chain = edge_table(spark, [(1, 2), (2, 3), (3, 4), (4, 5)])
    assert graph.prune(chain, min_degree=1).count() == 4
    left = {(r["src"], r["dst"]) for r in graph.prune(chain).collect()}
    assert left == {(2, 3), (3, 4)}
    nodes = {r["id"]: (r["degree"], r["size"]) for r in graph.interaction_nodes(chain.select(
        F.col("src").cast("string"), F.col("dst").cast("string"))).collect()}
    assert nodes == {"2": (1, 15.0), "3": (2, 25.0), "4": (1, 15.0)}


def test_single_vertex_centrality(spark):
    loop = edge_table(spark, [(1, 1)])
    assert graph.degree_centrality(loop).first()["centrality"] == 1.0


def test_interactions(spark):
    posts = spark.createDataFrame(
        [
            (1, "ann", "RT @bob: hi @bob @ann"),
            (2, "bob", "hey @ann"),
            (3, None, "@ann"),
            (4, "", "@ann"),
            (5, "cid", None),
        ],
        "post_id long, username string, text string",
    )
    rows = graph.interaction_edges(posts).collect()
    assert [tuple(r) for r in rows] == [
        ("ann", "bob", 4, 2, "mention, retweet", "mention, retweet (4 times)")
    ]
    assert sorted(tuple(r) for r in graph.edge_posts(posts).collect()) == [
        ("ann", "bob", 1), ("ann", "bob", 2)
    ]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    # One key holds a third of the rows, and has two partners.
    rows = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
    )
    dim = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (10, "d")], "k long, name string")
    plain = rows.join(dim, "k", how)
    salted = joins.salted_join(rows, dim, "k", how, floor=0)
    assert joins.hot_keys(joins.key_counts(rows, "k"), "k", floor=0) == [7]
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_prolific_author(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_FLOOR", 0)
    posts = spark.range(3000).select(
        F.col("id").alias("post_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("author_id")
    )
    users = spark.createDataFrame(
        [(1, "ann", 5, 6, 7), (1, "old", 5, 6, 1), (4, "bob", 1, 2, 3), (None, "x", 1, 1, 1)],
        "id long, username string, followers long, following long, total_posts long",
    )
    joined = engagement.posts_with_users(posts, users)
    assert joined.count() == 3000
    by_name = {r["username"]: r["count"] for r in joined.groupBy("username").count().collect()}
    assert by_name == {"ann": 1001, "bob": 1, "N/A": 1998}


def settled(near):
    labels, last = {v: v for v in near}, None
    while True:
        moved = {}
        for v in near:
            count = defaultdict(int)
            for u in near[v]:
                count[labels[u]] += 1
            moved[v] = min(count, key=lambda label: (-count[label], label))
        if moved == labels:
            return moved
        if moved == last:
            return {v: min(moved[v], labels[v]) for v in near}
        labels, last = moved, labels


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4)], [(1, 9)], random_edges(5, 12, 20)])
def test_label_propagation_until_it_settles(spark, edges):
    got = components.label_propagation(edge_table(spark, edges)).collect()
    assert {r["id"]: r["community"] for r in got} == settled(neighbours(edges))


def test_communities_are_numbered_in_order(spark):
    members = spark.range(500).select("id", (F.col("id") % 83 * 7).alias("component"))
    got = {r["id"]: r["community"] for r in communities.number_communities(members).collect()}
    assert got == {i: i % 83 + 1 for i in range(500)}


def test_registered_communities_settle_after_more_than_five_rounds(spark, monkeypatch):
    from chatterscope.checks import queries

    # A path whose labels need many rounds.
    edges = [(f"v{i:02d}", f"v{i + 1:02d}") for i in range(20)] + [("v00", "v02")]
    table = spark.createDataFrame([(a, b, 1) for a, b in edges], "src string, dst string, weight long")
    monkeypatch.setattr(queries, "network", lambda p: table)
    monkeypatch.setattr(queries.fixtures, "posts", lambda spark, sf_dir: None)
    want = settled(neighbours(edges))
    got = {n: {r["id"]: r["community"] for r in queries.QUERIES[n](spark, "").collect()} for n in ("communities", "communities_settled")}
    assert got["communities_settled"] == want
    assert got["communities"] != want


@pytest.mark.parametrize("size", [0, 1_000_000])
def test_paths_by_joins_and_by_arrays_are_the_same(spark, monkeypatch, size):
    monkeypatch.setattr(communities, "ARRAY_EDGES", size)
    monkeypatch.setattr(communities, "SLAB", 40)
    edges = [*random_edges(3, 9, 12), (20, 21), (21, 21)]
    table = edge_table(spark, edges)
    simple = [e for e in edges if e[0] != e[1]]
    scores = {(r["src"], r["dst"]): r["betweenness"] for r in communities.edge_betweenness(table, batch=3).collect()}
    assert scores == pytest.approx(brute_betweenness(simple), abs=1e-6)
    expected = brute_split(simple)
    numbers = {root: i + 1 for i, root in enumerate(sorted(set(expected.values())))}
    got = {r["id"]: r["community"] for r in communities.split_communities(table).collect()}
    assert got == {v: numbers[root] for v, root in expected.items()}


def test_a_small_component_is_split_without_rounds_by_level(spark, monkeypatch):
    monkeypatch.setattr(communities, "ShortestPaths", None)
    names = [(f"é{a}", f"é{b}") for a, b in random_edges(5, 10, 14)]
    table = spark.createDataFrame(names, "src string, dst string")
    expected = brute_split(sorted(names))
    numbers = {root: i + 1 for i, root in enumerate(sorted(set(expected.values())))}
    got = {r["id"]: r["community"] for r in communities.split_communities(table).collect()}
    assert got == {v: numbers[root] for v, root in expected.items()}
    empty = table.limit(0)
    assert communities.edge_betweenness(empty).isEmpty() and communities.split_communities(empty).isEmpty()


@pytest.mark.parametrize("bound", [1 << 20, 150, 0])
def test_components_fall_apart_on_their_own(spark, monkeypatch, bound):
    # Several components of several sizes, some alike, some with ties: small and large ways agree.
    monkeypatch.setattr(communities, "SMALL_COMPONENT", bound)
    monkeypatch.setattr(communities, "FIRST_TURN", 1)
    ring = [(100, 101), (101, 102), (102, 103), (100, 103)]
    same = [(a + 100, b + 100) for a, b in ring]
    edges = [*{(min(e), max(e)) for e in random_edges(5, 9, 16) if e[0] != e[1]}, *ring, *same, (300, 301), (301, 302), (300, 302)]
    got = {r["id"]: r["community"] for r in communities.split_communities(edge_table(spark, edges)).collect()}
    expected = brute_split(sorted(edges))
    numbers = {root: i + 1 for i, root in enumerate(sorted(set(expected.values())))}
    assert got == {v: numbers[root] for v, root in expected.items()}


def test_small_components_need_no_rounds(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("a round for a small component")

    monkeypatch.setattr(communities, "betweenness", refused)
    edges = edge_table(spark, [(i, i + d) for i in range(0, 400, 10) for d in (1, 2, 3)] + [(i + 1, i + 2) for i in range(0, 400, 10)])
    got = {r["id"]: r["community"] for r in communities.split_communities(edges).collect()}
    assert len(set(got.values())) == 41 and got[0] == got[1] == got[2] != got[3]
