"""Best-fit packing: whole documents, gapless sequences, few of them, every capacity kept."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from chatterscope.llm import packing
from chatterscope.llm.queries import QUERIES, TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"
SF = "/root/testdata/sf0.01"


def tokenizer() -> Tokenizer:
    known = Tokenizer.from_file(PATH)
    known.encode_special_tokens = True
    return known


def whole(texts: list[str | None]) -> list[list[int]]:
    found = tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids + [packing.END] for e in found]


def best_fit(lengths: list[int], limits: packing.Limits) -> int:
    """Sequences that best fit one piece after another takes."""
    bins: list[np.ndarray] = []
    for length in sorted(lengths, reverse=True):
        own = packing.vector(length)
        fit = [i for i, left in enumerate(bins) if (left >= own).all()]
        if fit:
            bad = [float(packing.badness(bins[i][None], length, limits)[0]) for i in fit]
            bins[fit[int(np.argmin(bad))]] -= own
        else:
            bins.append(limits.capacity() - own)
    return len(bins)


def test_query_packs_the_ids_of_all_documents(spark):
    rows = QUERIES["op13_packing"](spark, SF).collect()
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip([d["doc_id"] for d in documents], whole([d["text"] for d in documents])))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == ids.keys()
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == 1024 for r in own[1:]) and 0 < own[0]["length"] <= 1024
        at = 0
        for r in own:
            part = np.array(ids[doc][at : at + r["length"]], "<u4")
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids[doc])
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    least = math.ceil(sum(map(len, ids.values())) / 1024)
    assert len(by_sequence) <= least + 2


@pytest.mark.parametrize("measure", ["norm", "dot"])
@pytest.mark.parametrize("documents, attention", [(None, None), (3, None), (None, 2500)])
def test_plan_is_best_fit_of_one_piece_after_another(measure, documents, attention):
    limits = packing.Limits(64, documents, attention, measure=measure)
    random = np.random.default_rng(5)
    for most in (10, 30, 50):
        lengths = random.integers(1, most + 1, 300).tolist()
        kinds = packing.plan(Counter(lengths), limits)
        held = Counter()
        for kind in kinds:
            load = sum(n * packing.vector(length) for length, n in kind.holds)
            assert (load <= limits.capacity()).all()
            assert (limits.capacity() - load == kind.left).all()
            for length, n in kind.holds:
                held[length] += n * kind.count
        assert held == Counter(lengths)
        assert len(kinds) <= 2 * len(set(lengths))
        assert abs(sum(k.count for k in kinds) - best_fit(lengths, limits)) <= 1


def test_a_piece_that_no_sequence_takes_is_refused():
    with pytest.raises(ValueError):
        packing.plan({65: 1}, packing.Limits(64))
    with pytest.raises(ValueError):
        packing.plan({60: 1}, packing.Limits(64, attention=2500))


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    texts = [None, "", "a", "a", "word " * 5000, "z" * 30000, "<|endoftext|> \x1c \n\n  x"]
    rows = [(i if i else None, t, 7, "x") for i, t in enumerate(texts)] + [(3, "a", 7, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, offset int, `_at` string")
    cut = packing.pieces(table, PATH, 512, with_ids=True)
    packed = packing.pack(cut, packing.Limits(512))
    got = packed.collect()
    assert sum(r["length"] for r in got) == sum(map(len, whole([r[1] for r in rows])))
    long = sorted((r for r in got if r["doc_id"] == 4), key=lambda r: r["piece"])
    assert [i for r in long for i in r["ids"]] == whole([texts[4]])[0]
    held = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in held) == sum(r["length"] for r in got)
    for r in held:
        own = sorted((p for p in got if p["sequence_id"] == r["sequence_id"]), key=lambda p: p["offset"])
        assert r["ids"] == [i for p in own for i in p["ids"]]
        assert r["starts"] == [p["offset"] for p in own]
    named = cut.withColumn("_at", packing.F.lit("x")).withColumn("offset", packing.F.lit(9))
    assert packing.pack(named, packing.Limits(512)).filter("_at = 'x'").count() == len(got)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    packed = packing.pack(packing.pieces(none, PATH))
    assert packed.columns[-2:] == ["sequence_id", "offset"] and packed.count() == 0


def test_ranks_of_a_hot_length_are_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 7)
    rows = spark.range(100).selectExpr("id AS doc_id", "if(id < 90, 5, 3L) AS length")
    got = packing.pack(rows, packing.Limits(16)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 100
    assert len({r["sequence_id"] for r in got}) == 32
