import json

import pytest
from pyspark.sql import functions as F

from chatterscope import schema
from chatterscope.operators import engagement, tables
from chatterscope.plans import lineage
from chatterscope.sources import posts as sources

CSV = '''Tweet_ID,Text,Timestamp,Likes,Followers
1911111111111111111,"he said ""hi, all"" #AI
line2",2025-04-13 10:00:00+00:00,5,N/A
2,plain,2025-04-13 10:00:01+00:00,6,10
'''


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text(CSV, encoding="utf-8")
    df = sources.load_posts(spark, str(path), "csv")
    rows = df.orderBy(F.desc("post_id")).collect()
    assert [r["post_id"] for r in rows] == [1911111111111111111, 2]
    assert rows[0]["text"] == 'he said "hi, all" #AI\nline2'
    assert str(rows[0]["ts"]) and rows[0]["followers"] == "N/A"
    assert dict(sources.describe_columns(df))["ts"] == "timestamp"
    # A metric the file lacks is left out, not invented.
    assert [r["metric"] for r in engagement.engagement_totals(df).collect()] == ["likes"]


def test_csv_writes_arrays_as_json(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "post_id long, tags array<string>")
    sources.write_csv_posts(df, str(tmp_path / "out"))
    back = sources.read_csv_posts(spark, str(tmp_path / "out"), keep_extra=True)
    assert json.loads(back.first()["tags"]) == ["a", "b"]


def test_payload(spark, tmp_path):
    def user(i, name):
        return {"id": i, "username": name, "public_metrics": {
            "followers_count": 1, "following_count": 2, "tweet_count": 3}}

    def post(i, author):
        return {"id": i, "text": f"t{i}", "created_at": "2025-04-13T10:00:00Z", "author_id": author,
                "public_metrics": {"like_count": 4, "retweet_count": 5, "reply_count": 6, "quote_count": 7}}

    page = {"data": [post(1, 10), post(2, 11)], "includes": {"users": [user(10, "old"), user(10, "new")]}}
    (tmp_path / "page.json").write_text(json.dumps(page) + "\n" + json.dumps({"data": None}))
    df = sources.load_posts(spark, str(tmp_path / "page.json"), "payload")
    rows = [r.asDict() for r in df.orderBy("post_id").collect()]
    assert [r["username"] for r in rows] == ["new", "N/A"]
    assert [r["followers"] for r in rows] == ["1", "N/A"]
    assert rows[0]["likes"] == "4" and rows[0]["quotes"] == "7"
    assert set(df.columns) == {f.name for f in schema.POST_SCHEMA.fields}


def test_lines_and_parquet(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a\nb", "2024-01-01 05:00:00"), (2, None, "2024-01-02 05:00:00")],
        "post_id long, text string, ts string",
    ).withColumn("ts", F.to_timestamp("ts"))
    assert [r["value"] for r in sources.posts_to_lines(df).collect()] == ["a b"]
    sources.write_posts(df, str(tmp_path / "days"))
    back = sources.load_posts(spark, str(tmp_path / "days"))
    assert back.filter(F.col("day") == F.lit("2024-01-02").cast("date")).count() == 1
    sources.write_charts({"days": back.groupBy("day").count()}, str(tmp_path / "charts"))
    assert spark.read.parquet(str(tmp_path / "charts" / "days")).count() == 2


def test_coerced_numbers(spark):
    df = spark.createDataFrame(
        [("5",), (" 7 ",), ("5d",), ("N/A",), (None,), ("2.5",), ("-1e2",)], "likes string"
    )
    got = [r["likes"] for r in engagement.coerce_metrics(df).collect()]
    assert got == [5.0, 7.0, 0.0, 0.0, 0.0, 2.5, -100.0]
    assert [r["likes"] for r in engagement.cast_metrics(df).collect()][:3] == [5, 7, None]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "post_id long, username string, likes string, sentiment string")
    assert tuple(engagement.key_metrics(empty).first()) == (0, 0, 0, 0)
    assert tuple(tables.dedup_stats(empty).first()) == (0, 0, 0)
    no_metrics = empty.select("post_id")
    assert engagement.engagement_totals(no_metrics).columns == ["metric", "total"]


def test_merge_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "id long, t string")
    b = spark.createDataFrame([(3,)], "id long")
    merged = tables.merge_posts(a, b)
    assert sorted((r["id"], r["t"]) for r in merged.collect()) == [(1, "x"), (2, None), (3, None)]


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, master, named=None):
        self.sparkContext = FakeContext(master)
        self.conf = {lineage.SETTING: named} if named else {}


def test_shared_dir(spark, tmp_path):
    assert lineage.shared_dir(FakeSession("spark://host:1", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        lineage.shared_dir(FakeSession("spark://host:1"))
    assert lineage.shared_dir(spark) == spark.conf.get(lineage.SETTING)


def test_days_are_written_in_few_files(spark, tmp_path):
    rows = spark.range(2000, numPartitions=16).select(
        F.col("id").alias("post_id"),
        F.timestamp_seconds(F.col("id") % 10 * 86400 + 1_700_000_000).alias("ts"),
    )
    sources.write_posts(rows, str(tmp_path / "posts"))
    assert len(list((tmp_path / "posts").glob("day=*/*.parquet"))) <= 20
    assert spark.read.parquet(str(tmp_path / "posts")).count() == 2000
