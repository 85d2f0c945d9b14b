import time

import pytest
from pyspark.errors import StreamingQueryException

from chatterscope.streaming import commits
from chatterscope.streaming import hashtags as streams


def found(spark, out):
    return sorted(r["hashtag"] for r in commits.read_committed(spark, out).collect())


def lost(*_):
    raise ConnectionError("no record")


def test_a_stop_before_the_record_loses_and_repeats_nothing(spark, tmp_path):
    """Under the 5-second trigger: stopped between write and record, and started again."""
    lines, out, state = (str(tmp_path / n) for n in ("lines", "out", "state"))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text("#a #b\n#a x\n")

    def start(writer):
        return streams.start_hashtags(streams.read_lines(spark, lines), state, writer)

    assert found(spark, out) == []
    failing = start(commits.committed_batches(out, lost))
    with pytest.raises(StreamingQueryException, match="no record"):
        failing.awaitTermination(60)
    assert list((tmp_path / "out" / "data").rglob("*.parquet")) and found(spark, out) == []

    again = start(commits.committed_batches(out))
    try:
        again.processAllAvailable()
        assert found(spark, out) == ["#a", "#a", "#b"]
        (tmp_path / "lines" / "b.txt").write_text("#c\n")
        begun = time.time()
        again.processAllAvailable()
        assert found(spark, out) == ["#a", "#a", "#b", "#c"] and time.time() - begun < 60
    finally:
        again.stop()


def test_a_recorded_batch_is_not_written_again(spark, tmp_path):
    out = str(tmp_path / "out")
    write = commits.committed_batches(out)
    for _ in range(2):
        write(spark.createDataFrame([("#a",)], "hashtag string"), 3)
    assert found(spark, out) == ["#a"]
    # Two drivers recorded the batch: one attempt counts.
    other = spark.createDataFrame([("#a",)], "hashtag string")
    other.write.parquet(f"{out}/data/batch=3/attempt=0")
    commits.commit(spark, out, 3, "0")
    assert found(spark, out) == ["#a"]


def test_an_empty_batch_writes_nothing(spark, tmp_path):
    out = tmp_path / "out"
    commits.committed_batches(str(out))(spark.createDataFrame([], "hashtag string"), 1)
    assert not out.exists() and found(spark, str(out)) == []
