import numpy as np

from chatterscope.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, id string, v int"


def brute(rows, k):
    usable = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        if any(v):
            usable.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = []
    for q in sorted(i for i in usable if i % 5 == 0):
        mine = min(usable[q], key=list)
        found = []
        for i, vectors in usable.items():
            near = [np.sqrt(sum((a - mine) ** 2)) for a in vectors if len(a) == len(mine)]
            if i != q and near:
                found.append((min(near), i))
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return out


def search(spark, rows, k=4):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return [tuple(r) for r in nearest.nearest(df, df.filter("vec_id % 5 = 0"), k).orderBy("query_id", "rank").collect()]


def test_same_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "ROUND_BYTES", 4 * 6 * 8)
    monkeypatch.setattr(nearest, "QUERY_BYTES", 2 * 6 * 8)
    monkeypatch.setattr(nearest, "CANDIDATE_BYTES", 7 * 6 * 8)
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=6).round(1).tolist()) for i in range(60)]
    rows += [(60 + i, rows[3][1]) for i in range(8)]  # ties
    rows += [(100, None), (105, [0.0] * 6), (110, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (115, [float("nan")] * 6)]
    rows += [(120, [float("inf")] * 6), (None, [1.0] * 6), (125, []), (130, [1.0, 2.0]), (135, [2.0, 2.0])]
    rows += [rows[7], (5, [9.0] * 6)]  # a repeated row, an id with two vectors
    got, want = search(spark, rows), brute(rows, 4)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_few_and_no_rows(spark):
    assert search(spark, []) == []
    assert search(spark, [(5, [1.0])]) == []
    assert [g[:3] for g in search(spark, [(5, [1.0]), (6, [2.0])])] == [(5, 1, 6)]


def test_bounds_hold():
    random = np.random.default_rng(2)
    a, b = random.normal(size=(20, 1500)) * 9, random.normal(size=(30, 1500))
    low, high = nearest.square_bounds(nearest.Coded(a), nearest.Coded(b))
    exact = ((a[:, None] - b[None]) ** 2).sum(2)
    assert (low <= exact).all() and (exact <= high).all()


def test_rows_that_all_occur_k_times(spark):
    random = np.random.default_rng(3)
    once = [(i, random.normal(size=6).tolist()) for i in range(40)]
    once += [(i, random.normal(size=6).tolist()) for i in range(0, 40, 3)]  # ids with two vectors
    got, want = search(spark, once * 4), brute(once, 4)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_bar_of_a_block_is_over_ids():
    random = np.random.default_rng(4)
    rows, ids = np.repeat(random.normal(size=(40, 8)), 2, axis=0), np.repeat(np.arange(40), 2)
    heaps = {}
    nearest.tile(nearest.Coded(rows[:1]), ids[:1], nearest.Coded(rows), ids, heaps, 10)
    exact = sorted((np.linalg.norm(rows[2 * i] - rows[0]), i) for i in range(1, 40))[:10]
    assert [-i for _, i in sorted(heaps[0], reverse=True)] == [i for _, i in exact]


def test_blocks_are_bounded_by_bytes(spark):
    rows = [(i, [float(i + 1)] * n) for n, ids in ((3, range(50)), (40, range(50, 61)), (900, [70, 71])) for i in ids]
    df = spark.createDataFrame(rows, "id long, v array<double>").coalesce(1)
    packed = nearest.blocks(df, 1000).collect()
    assert all(r["n"] == 1 or len(r["data"]) <= 1000 for r in packed)
    assert sorted(i for r in packed for i in np.frombuffer(r["ids"], np.int64).tolist()) == [i for i, _ in rows]
    assert max(r["n"] for r in packed) == 1000 // 24 and {r["n"] for r in packed if r["dims"] == 900} == {1}
