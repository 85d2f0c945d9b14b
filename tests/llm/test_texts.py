import numpy as np
import pyarrow as pa

from chatterscope.llm import texts

SAMPLES = ["one two  two", None, "", "  ", "Ünïcode\tword\x0b\x0cx", "a" * 3000, "one"]


def test_words_are_runs_of_other_bytes_than_separators():
    found_words = []
    column = pa.array(SAMPLES, pa.string())
    for row, end, data, offsets in texts.chunks(column, limit=10):
        found = texts.words(data, offsets)
        raw = data.tobytes()
        for i in range(end - row):
            span = range(found.offsets[i], found.offsets[i + 1])
            found_words.append([raw[found.starts[j] : found.ends[j]] for j in span])
    assert found_words == [(t or "").encode().split() for t in SAMPLES]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    data, offsets = texts.bytes_of(pa.array(["x one", "one y One", "  one"]))
    found = texts.words(data, offsets)
    assert found.hashes[1] == found.hashes[2] == found.hashes[5] != found.hashes[4]
    folded = texts.words(data, offsets, fold=True)
    assert folded.hashes[4] == folded.hashes[2] == found.hashes[2]


def test_windows_depend_on_order():
    values = np.array([1, 2, 3, 1, 2, 3, 2, 1], np.uint64)
    hashes = texts.windows(values, 3)
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 5
    assert len(texts.windows(values, 9)) == 0


def test_sliced_arrays_keep_their_texts():
    column = pa.array(["aa", "bb", "cc", None, "dd"]).slice(1, 3)
    data, offsets = texts.bytes_of(column)
    assert data.tobytes() == b"bbcc" and offsets.tolist() == [0, 2, 4, 4]
