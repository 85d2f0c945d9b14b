"""Conversation repair against a search of all edits, in one task and over many."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from chatterscope.llm import turns
from chatterscope.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
WANTED = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def fault_of(row, seen):
    if not row[1].strip(SPACE):
        return "blank"
    if row in seen:
        return "duplicate"
    return None if row[1].strip(SPACE)[-1] in ".!?" else "truncated"


def cheapest(rows, kinds):
    """(cost, letters, repaired rows) of the best edits, by search in order of (cost, letters)."""
    open_paths = [(0, "", 0, "", ())]
    done = set()
    while open_paths:
        cost, letters, i, last, kept = heapq.heappop(open_paths)
        if i == len(rows) and last in ("", "a"):
            return cost, letters, kept
        if (i, last) in done:
            continue
        done.add((i, last))
        if letters[-3:] != "III":
            new = WANTED[last]
            heapq.heappush(open_paths, (cost + 5, letters + "I", i, new, (*kept, (NAMES[new], ""))))
        if i == len(rows):
            continue
        role, text = rows[i]
        heapq.heappush(open_paths, (cost + 2, letters + "D", i + 1, last, kept))
        if kinds[i] in ("blank", "duplicate"):
            continue
        late = 5 if kinds[i] == "truncated" else 0
        initial = role[:1]
        if (last, initial) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
            heapq.heappush(open_paths, (cost + late, letters + "K", i + 1, initial, (*kept, (role, text))))
        new = WANTED[last]
        heapq.heappush(open_paths, (cost + late + 1, letters + "R", i + 1, new, (*kept, (NAMES[new], text))))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def expected(rows):
    """The query's row of each conversation."""
    by_conv = {r[0]: [] for r in rows}
    for row in damaged(rows):
        by_conv[row[0]].append(row)
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said = [r[2:] for r in own]
        kinds = [fault_of(s, said[:i]) for i, s in enumerate(said)]
        known = [r[1] for r in own if r[1] is not None]
        cost, letters, kept = cheapest(said, kinds) if said else (0, "", ())
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])),
            cost,
            letters,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


def found(rows):
    return {r[0]: tuple(r)[1:] for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string, at int, symbol string, n string"
TEXTS = ["Yes.", "no", "Oh!", "", " \t", "ends. \n", "cut off,", "Why?"]


def random_rows(seed, conversations=60, most=30, texts=TEXTS):
    random = np.random.default_rng(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(random.integers(1, most)):
            role = random.choice(["system", "user", "assistant", "tool", "sys"], p=[0.1, 0.4, 0.35, 0.1, 0.05])
            text = texts[random.integers(len(texts))] if random.random() < 0.7 else f"{turn} {random.random()}."
            rows.append((conv, int(turn), str(role), text))
    return rows


def query(spark, rows, tmp_path):
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    table.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return found(QUERIES["op11_turns"](spark, str(tmp_path)).collect())


def test_random_conversations(spark, tmp_path):
    rows = random_rows(1)
    assert query(spark, rows, tmp_path) == expected(rows)


def test_a_conversation_over_many_tasks(spark, tmp_path):
    rows = random_rows(2, conversations=1, most=2)[:0]
    for conv, size in ((0, 3), (1, 900), (2, 2), (3, 250), (None, 400)):
        rows += [(conv, *r[1:]) for r in random_rows(size, 1, size + 1)[:size]]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
        ordered = turns.in_order(turns.faults(table))
        tasks = ordered.selectExpr("conv_id", f"at >> {turns.TASK_BITS} AS task").distinct()
        assert tasks.filter("conv_id = 1").count() > 3
        assert query(spark, rows, tmp_path) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_nulls_repeats_ties_and_long_texts(spark, tmp_path):
    rows = random_rows(4, 8, 12)
    rows += [
        (None, 1, "user", "Hi."),
        (None, None, None, None),
        (None, None, "assistant", "Ok."),
        (90, None, "user", "Hi."),
        (90, None, "user", "Hi."),
        (90, 3, "user", "Hi."),
        (91, None, "assistant", None),
        (92, 1, "", "Hi."),
        (92, 2, "user", "word " * 40000 + "."),
        (92, 2, "user", "word " * 40000 + "!"),
        (93, 5, "user", "x. 　"),
        (94, -3, "assistant", "A."),
        (94, 7, "user", "B."),
    ]
    rows += rows[:20]
    assert query(spark, rows, tmp_path) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path) == {}


def test_whole_table_and_the_edits_themselves(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    want = expected(rows)
    assert found(QUERIES["op11_turns"](spark, "/root/testdata/sf0.01").collect()) == want
    edits = turns.repair(turns.damage(conversations)).orderBy("at", "step").collect()
    kept, letters = defaultdict(str), defaultdict(str)
    for e in edits:
        letters[e["conv_id"]] += e["edit"]
        kept[e["conv_id"]] += e["new_role"][0] if e["new_role"] else ""
        assert (e["new_role"] is None) == (e["edit"] == "D")
        assert (e["text"] is None) == (e["edit"] == "I")
    assert all(re.fullmatch("(s?(ua)+)?", k) for k in kept.values())
    assert all(want[c][6] == letters[c] for c in want)


@pytest.mark.parametrize("block", [1, 2, 3])
def test_blocks_of_any_length_give_the_same_edits(monkeypatch, block):
    random = np.random.default_rng(7)
    cases = [bytes(random.integers(0, turns.GONE + 1, n).astype(np.uint8)) for n in range(1, 40)]
    want = [turns.edits_of(c) for c in cases]
    monkeypatch.setattr(turns, "BLOCK", block)
    turns.tables.cache_clear()
    try:
        assert [turns.edits_of(c) for c in cases] == want
    finally:
        turns.tables.cache_clear()


def test_summaries_compose():
    random = np.random.default_rng(8)
    for _ in range(20):
        symbols = [bytes(random.integers(0, turns.GONE + 1, random.integers(1, 30)).astype(np.uint8)) for _ in range(4)]
        parts = [
            {"task": i, "last": False, "conv_id": None, "to": to, "leave": leave}
            for i, (to, leave) in enumerate(map(turns.summary, symbols))
        ]
        links = turns.linked(parts)
        letters, q = [], turns.START
        for i, own in enumerate(symbols):
            v, front, ends = links[i, False]
            assert front == q and ends == (i == 3)
            some, q = turns.edits_of(own, v, front)
            letters += some
        assert (letters, q) == turns.edits_of(b"".join(symbols))
