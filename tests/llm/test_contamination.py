import random
import re

from chatterscope.llm import contamination as c

SCHEMA = "doc_id long, text string, item_id int, words string, seed int"
ITEMS = "item_id int, text string, doc_id string"


def words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(documents, benchmark):
    out = {}
    for d, text in documents:
        for i, item in benchmark:
            a, b = words(text), words(item)
            if d is None or i is None or len(b) < 9:
                continue
            size = min(13, len(b))
            for diagonal in range(-len(b), len(a)):
                equal = [0 <= diagonal + j < len(a) and a[diagonal + j] == w for j, w in enumerate(b)]
                best = max(sum(equal[j : j + size]) for j in range(len(b) - size + 1))
                if best >= size - 2 * size // 13:
                    out[d, i] = max(out.get((d, i), 0), sum(equal))
    return out


def test_same_as_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(60)]
    benchmark = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([5, 9, 12, 13, 20, 40])))) for i in range(12)]
    benchmark += [(3, benchmark[3][1]), (None, benchmark[4][1]), (50, None), (51, "")]
    documents = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(10)]
    for i, (_, item) in enumerate(benchmark[:12]):
        for changed in range(4):
            part = item.split()[: rng.choice([13, 20, 40])]
            for j in rng.sample(range(len(part)), min(changed, len(part))):
                part[j] = "changed"
            around = " ".join(rng.choices(vocabulary, k=5))
            documents.append((100 + 10 * i + changed, f"{around.upper()}, {' '.join(part)}! {around}"))
    documents += [documents[12], (None, documents[13][1]), (500, None), (501, ""), (502, documents[15][1] * 60)]
    left = spark.createDataFrame([(*r, 1, "x", 2) for r in documents], SCHEMA)
    right = spark.createDataFrame([(*r, "x") for r in benchmark], ITEMS)
    want = brute(documents, benchmark)
    for bound in (c.MAX_BROADCAST_ROWS, 0):
        monkeypatch.setattr(c, "MAX_BROADCAST_ROWS", bound)
        found = c.overlaps(left, right).collect()
        assert {(r["doc_id"], r["item_id"]): r["matched_words"] for r in found} == want
        assert len(found) == len(want) and len(want) > 10
    kept = c.without_benchmark(left, right)
    gone = {d for d, _ in want}
    assert kept.columns == left.columns
    assert sorted(map(str, [r["doc_id"] for r in kept.collect()])) == sorted(
        str(d) for d, _ in documents if d not in gone
    )


def test_every_tolerated_substitution_leaves_a_seed():
    from itertools import combinations

    span = c._span(c.MASKS)
    places = [{p + o for o in m} for m in c.MASKS for p in range(c.WINDOW - span + 1)]
    for changed in combinations(range(c.WINDOW), c.SUBSTITUTED):
        assert any(not place & set(changed) for place in places)


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a " * 20, 1, "x", 1)], SCHEMA)
    assert c.overlaps(none, items).isEmpty() and c.overlaps(some, items).isEmpty()
    assert c.without_benchmark(some, items).count() == 1


def test_items_of_every_length_with_every_tolerated_replacement(spark):
    from itertools import combinations

    items, documents, want = [], [], {}
    for n in range(1, 15):
        mine = [f"w{n}x{j}" for j in range(n)]
        items.append((n, " ".join(mine)))
        allowed = 2 * min(n, 13) // 13
        for changed in (c for k in range(allowed + 2) for c in combinations(range(n), k)):
            text = " ".join("other" if j in changed else w for j, w in enumerate(mine))
            for around in ("{}", "before {} after"):
                documents.append((len(documents), around.format(text)))
                if len(changed) <= allowed or n == 14 and max(sum(j not in changed for j in p) for p in (range(13), range(1, 14))) > 10:
                    want[documents[-1][0], n] = n - len(changed)
    documents.append((-1, "w2x0"))  # the edge of a document cuts an item
    documents.append((-9, items[8][1].split(" ", 1)[1]))
    want[-9, 9] = 8
    documents.append((-3, "w1x0 " * 3000 + items[2][1]))
    want.update({(-3, 1): 1, (-3, 3): 3})
    left = spark.createDataFrame([(*r, 1, "x", 2) for r in documents], SCHEMA)
    right = spark.createDataFrame([(*r, "x") for r in items], ITEMS)
    found = c.overlaps(left, right, shortest=1).collect()
    assert len(found) == len(want)
    assert {(r["doc_id"], r["item_id"]): r["matched_words"] for r in found} == want
    usual = {(r["doc_id"], r["item_id"]) for r in c.overlaps(left, right).collect()}
    assert usual == {k for k in want if k[1] >= c.SHORTEST}


def test_pipeline_drops_copies_of_short_items(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "one two three", "x")], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "zero one, two THREE four", 1, "x", 1), (2, "one two four", 1, "x", 1)], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert [r["doc_id"] for r in kept.collect()] == [2]
    from chatterscope.llm.queries import QUERIES

    found = QUERIES["op8_contamination"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [(1, 1, 3, 3)]


def test_sql_of_the_query_takes_items_of_every_length(spark, tmp_path):
    """One word replaced at each place of items of 1 to 14 words, and each one whole."""
    import duckdb

    from chatterscope.llm.queries import ORACLE, QUERIES

    items, documents = [], []
    for size in range(1, 15):
        item = [f"w{size}x{i}" for i in range(size)]
        items.append((size, " ".join(item)))
        for place in range(-1, size):
            words = [w if i != place else "other" for i, w in enumerate(item)]
            documents.append((100 * size + place + 1, "before " + " ".join(words) + " after"))
    items += [(90, None), (91, ""), (None, "w3x0 w3x1 w3x2")]
    documents += [(9000, None), (9001, ""), (9002, "w1x0 w1x0"), (None, "w1x0")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op8_contamination"](spark, str(tmp_path)).select(
        "doc_id", "item_id", "matched_words", "item_words").collect()]
    database = duckdb.connect()
    for name in ("documents", "benchmark"):
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = database.execute(
        f"SELECT doc_id, item_id, matched_words, item_words FROM ({ORACLE['op8_contamination']})"
    ).fetchall()
    assert sorted(got) == sorted(want) and len(want) > 60
