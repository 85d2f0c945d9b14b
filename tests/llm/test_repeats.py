import random

import numpy as np

from chatterscope.llm import passages, substrings, texts

SCHEMA = "doc_id long, text string, id string, digest int, start int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def corpus():
    rng = random.Random(2)
    vocabulary = ["the", "of", "ñandú", "dog", "cat", "a", "überall"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 8, 40, 60])))) for i in range(12)]
    passage = " ".join(rng.choices(vocabulary, k=12))
    rows += [(20 + i, f"{rng.choice(vocabulary)} x{i} {passage} y{i}\t\n z") for i in range(6)]
    rows += [(30, rows[3][1]), (31, rows[3][1]), (40, None), (41, ""), (42, "dup " * 50), (43, "dup " * 60)]
    rows += [(50, rows[5][1] + "!" + rows[6][1]), (2, "ab" * 700)]
    return rows


def words_brute(rows, size):
    rows = sorted(set(rows), key=lambda r: r[0])
    seen, out = set(), {}
    for d, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out[d, text or ""] = (len(words), len(gone), kept)
    return out


def test_windows_that_start_earlier_go(spark):
    rows = [r for r in corpus() if r[0] != 2 or r[1].startswith("ab")]
    rule = passages.Rule(window=5, phrase=2)
    got = passages.without_repeats(frame(spark, [*rows, rows[4]]), rule).collect()
    want = words_brute(rows, 5)
    assert len(got) == len(rows) + 1
    by_id = {d: v for (d, _), v in want.items()}
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == by_id


def test_the_hits_of_the_automaton_name_the_windows():
    """Without hits there are no units; with those of one phrase, the windows that hold it."""
    rule = passages.Rule(window=4, phrase=2)
    rows = ["a b c d e f g".encode(), "x a b c d y".encode(), b"", "a b".encode()]
    data = np.frombuffer(b"".join(rows), np.uint8)
    offsets = np.cumsum([0, *map(len, rows)])
    found = texts.words(data, offsets)
    ids = np.arange(4)

    def units(hits):
        batch = passages._unit_batch(found, hits, rule, ids, ids)
        if batch is None:
            return []
        return [(r["id"], r["start"], r["n"]) for r in batch.to_pylist()]

    bare = passages.located(data, found, None, rule)
    assert (bare == passages.NO_HIT).all() and units(bare) == []
    phrase = texts.windows(found.hashes, 2)[[2]]
    hits = passages.located(data, found, passages.compiled(data, found, phrase, rule), rule)
    assert np.flatnonzero(hits != passages.NO_HIT).tolist() == [2, 10]
    assert set(hits[[2, 10]].tolist()) == set(phrase.tolist())
    # "c d" is in the windows that begin at words 0 to 2 and, of the second text, 1 and 2.
    assert units(hits) == [(0, 0, 3), (1, 1, 2)]
    assert passages.compiled(data, found, np.zeros(0, np.uint64), rule) is None


def bytes_brute(rows, size):
    by_string = {}
    for d, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - size + 1):
            s = data[i : i + size]
            by_string[s] = min(d, by_string.get(s, d))
    out = {}
    for d, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - size + 1):
            if by_string[data[i : i + size]] < d:
                gone[i : i + size] = True
        spans = int(np.count_nonzero(np.diff(np.append(0, gone.astype(int))) == 1))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.setdefault(d, set()).add((len(data), int(gone.sum()), spans, kept))
    return out


def test_strings_of_earlier_documents_go(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 500)
    monkeypatch.setattr(substrings, "UNITS", 3)
    rows = corpus()
    rule = substrings.Rule(least=12, gram=5)
    got = substrings.without_repeats(frame(spark, [*rows, rows[4]]), rule).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], set()).add((*tuple(r)[1:4], bytes(r["kept"])))
    assert len(got) == len(rows) + 1 and found == bytes_brute(rows, 12)


def test_null_ids_and_no_rows(spark):
    rows = [(None, "a b c d e f g"), (1, "a b c d e f g")]
    for run, rule in (
        (passages.without_repeats, passages.Rule(3, 2)),
        (substrings.without_repeats, substrings.Rule(6, 3)),
    ):
        got = {r["doc_id"]: r["n_removed"] for r in run(frame(spark, rows), rule).collect()}
        assert got[None] == 0 and got[1] > 0
        assert run(frame(spark, []), rule).isEmpty()


def repeats_brute(strings, least):
    places = {}
    for i, s in enumerate(strings):
        for a in range(len(s)):
            for b in range(a + least, len(s) + 1):
                places.setdefault(s[a:b], []).append((i, a))
    out = set()
    for s, occurrences in places.items():
        before = {strings[i][a - 1] if a else (i,) for i, a in occurrences}
        after = {strings[i][a + len(s) : a + len(s) + 1] or (i,) for i, a in occurrences}
        if len(occurrences) > 1 and len(before) > 1 and len(after) > 1:
            out.add((len(s), tuple(sorted(occurrences))))
    return out


def test_maximal_repeats_with_all_occurrences():
    rng = random.Random(4)
    for _ in range(80):
        strings = [bytes(rng.choices(b"ab\x00", k=rng.randint(1, 25))) for _ in range(rng.randint(1, 6))]
        found = {
            (r.length, tuple(sorted(zip(r.strings.tolist(), r.offsets.tolist(), strict=True))))
            for r in substrings.maximal_repeats(strings, 3)
        }
        assert found == repeats_brute(strings, 3)
    assert substrings.maximal_repeats([], 3) == []


def test_a_gram_of_very_many_contexts_makes_no_large_suffix_array(spark, monkeypatch):
    """One gram in many contexts, some of which recur; SuffixArray refuses more than twice UNITS."""
    rng = random.Random(5)
    rule = substrings.Rule(least=12, gram=5)
    monkeypatch.setattr(substrings, "UNITS", 8)
    gram = min(
        ("".join(rng.choices("abcdefgh", k=5)) for _ in range(4000)),
        key=lambda g: substrings.gram_hashes(np.frombuffer(g.encode(), np.uint8), 5)[0],
    )
    around = ["".join(rng.choices("abcdefgh", k=9)) for _ in range(40)]
    rows = [(i, f"{i:03d}{rng.choice(around)}{gram}{rng.choice(around)}{i:03d}") for i in range(200)]
    rows += [(300, rows[3][1] + rows[4][1]), (301, rows[3][1]), (7, rows[8][1])]
    units = {r[1][3:26] for r in rows[:200]}
    assert len(units) > 100
    sizes = []
    made = substrings.SuffixArray.__init__

    def watched(self, strings, least):
        sizes.append(len(strings))
        made(self, strings, least)

    # The stream of units itself, run here: what a task of Spark holds at once.
    monkeypatch.setattr(substrings.SuffixArray, "__init__", watched)
    streams = []

    class Table:
        def __getattr__(self, name):
            return lambda *a, **b: self

        def mapInArrow(self, run, schema):
            streams.append(run)
            return self

    substrings._repeats(Table(), rule)
    import pyarrow as pa

    listed = sorted((1, d, d, 0, t.encode()[3:26]) for d, t in rows[:200])
    listed.sort(key=lambda r: (r[4], r[1]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*listed, strict=True), kinds, strict=True)],
        ["gram", "id", "digest", "start", "bytes"],
    )
    found = [r for b in streams[0](iter([batch])) for r in b.to_pylist()]
    assert found and max(sizes, default=0) <= 16
    monkeypatch.undo()
    monkeypatch.setattr(substrings, "UNITS", 8)
    got = {}
    for r in substrings.without_repeats(frame(spark, rows), rule).collect():
        got.setdefault(r["doc_id"], set()).add((*tuple(r)[1:4], bytes(r["kept"])))
    assert got == bytes_brute(rows, 12)
    assert sum(n for v in got.values() for _, n, _, _ in v) > 500
