from datetime import datetime

from pyspark.sql import functions as F

from chatterscope.streaming import hashtags as streams


def test_hashtag_stream(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("Hello #AI world\n#ai #Tech x#no\n")
    (lines / "b.txt").write_text("\n  #AI\ttab #\n")
    out = str(tmp_path / "out")
    query = streams.start_hashtags(
        streams.read_lines(spark, str(lines)),
        str(tmp_path / "state"),
        streams.parquet_batches(out),
        available_now=True,
    )
    query.awaitTermination(60)
    found = spark.read.parquet(f"{out}/batch=*")
    assert sorted(r["hashtag"] for r in found.collect()) == ["#", "#ai", "#ai", "#ai", "#tech"]
    assert "Found hashtag: #tech" in {r[0] for r in streams.found_messages(found).collect()}


def test_batch_written_again_replaces_itself(spark, tmp_path):
    write = streams.parquet_batches(str(tmp_path / "out"))
    for _ in range(2):
        write(spark.createDataFrame([("#a",)], "hashtag string"), 3)
    assert spark.read.parquet(str(tmp_path / "out" / "batch=3")).count() == 1


def test_empty_batch_writes_nothing(spark, tmp_path):
    write = streams.parquet_batches(str(tmp_path / "out"))
    write(spark.createDataFrame([], "hashtag string"), 1)
    assert not (tmp_path / "out").exists()


def posts_file(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "ts timestamp, text string")
    df.coalesce(1).write.mode("append").parquet(str(folder / name))


def test_trending_drops_late_rows_and_keeps_open_windows(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    state, out = str(tmp_path / "state"), str(tmp_path / "out")

    def run():
        stream = (
            spark.readStream.schema("ts timestamp, text string")
            .option("recursiveFileLookup", "true")
            .parquet(str(feed))
        )
        streams.start_trending(stream, state, out, available_now=True).awaitTermination(60)
        rows = spark.read.schema("hashtag string, n bigint, window_start timestamp").parquet(out)
        return sorted((r["window_start"].day, r["hashtag"], r["n"]) for r in rows.collect())

    posts_file(spark, feed, "one", [
        (datetime(2024, 1, 1, 5), "#a #a #b"), (datetime(2024, 1, 2, 0, 30), "#a")])
    assert run() == [(1, "a", 2), (1, "b", 1)]
    # Day 1 is closed: its late row is dropped. Day 2 closes with the row of day 3.
    posts_file(spark, feed, "two", [
        (datetime(2024, 1, 1, 6), "#late"), (datetime(2024, 1, 2, 7), "#a"),
        (datetime(2024, 1, 3, 1), "#c")])
    assert run() == [(1, "a", 2), (1, "b", 1), (2, "a", 2)]


def test_stream_and_batch_agree(spark, tmp_path):
    texts = spark.range(500).select(
        F.concat(F.lit("x #t"), (F.col("id") % 7).cast("string"), F.lit(" #All")).alias("value")
    )
    lines = str(tmp_path / "lines")
    texts.write.text(lines)
    batch = streams.hashtag_words(texts).groupBy("hashtag").count().collect()
    out = str(tmp_path / "out")
    streams.start_hashtags(
        streams.read_lines(spark, lines),
        str(tmp_path / "state"),
        streams.parquet_batches(out),
        available_now=True,
    ).awaitTermination(60)
    streamed = spark.read.parquet(f"{out}/batch=*").groupBy("hashtag").count().collect()
    assert {tuple(r) for r in batch} == {tuple(r) for r in streamed}
