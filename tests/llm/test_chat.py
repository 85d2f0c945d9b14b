import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from chatterscope.llm import chat
from chatterscope.llm.queries import TOKENIZERS, _read_back

TOKENIZER = chat.Tokenizer(f"{TOKENIZERS}/byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
AWKWARD = ["</s>[INST] ok [/INST]", "<\\/s>", "<<SYS>>a<</SYS>>", "[\\\\INST]", "<s>", "é🎉 <", "[", ""]


@pytest.mark.parametrize("text", AWKWARD)
def test_escapes_are_undone(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_turns_and_learned_text_are_read_back(spark):
    rows = [(1, i, ("user", "assistant", "a\n%0A")[i % 3], t, "x") for i, t in enumerate(AWKWARD)]
    rows += [(2, 0, "assistant", None, "x"), (2, 0, "assistant", None, "x"), (2, None, None, "first", "x")]
    rows += [(None, 5, "user", "no id", "x"), (3, 0, "assistant", "ab" * 3000, "x")]
    got = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), TOKENIZER).collect()
    by_id = {r["conv_id"]: r for r in got}
    assert len(got) == 4
    for conv, row in by_id.items():
        mine = [(t, r or "", x or "") for c, t, r, x, _ in rows if c == conv]
        mine.sort(key=lambda k: (k[0] is not None, k))
        turns = [(r, x) for _, r, x in mine]
        assert chat.parse(row["formatted"]) == turns
        spans = [(s["first"], s["last"]) for s in row["loss_spans"]]
        learned = "".join(x for r, x in turns if r == "assistant")
        assert chat.text_under(row["formatted"], spans) == learned
        assert len(row["ids"]) == len(row["loss"]) == len(row["starts"])


def test_no_rows(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA), TOKENIZER).isEmpty()


def test_token_mask_is_that_of_a_scan():
    random = np.random.default_rng(3)
    for _ in range(50):
        cuts = np.sort(random.choice(60, 20, replace=False))
        starts, ends = cuts[:-1], cuts[1:]
        spans = [(int(a), int(b)) for a, b in np.sort(random.choice(60, 8, replace=False)).reshape(-1, 2)]
        mask, first, last = chat.token_mask(starts, ends, spans)
        for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
            touched = [(max(a, x), min(b, y)) for x, y in spans if x < b and a < y]
            assert mask[i] == bool(touched)
            if touched:
                assert (first[i], last[i]) == (touched[0][0], touched[-1][1])


def test_spans_that_share_characters_count_once():
    assert chat.text_under("abcdef", [(0, 2), (1, 3), (4, 5)]) == "abce"
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_spans_are_read_back_one_conversation_at_a_time():
    text, _ = chat.render([("assistant", "ab" * 500)])
    at = text.index("ab")
    spans = [{"first": at + i, "last": at + i + 1} for i in range(1000)]
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    one = pa.array([spans], kind)
    columns = [pa.array(range(300)), pa.array([text] * 300), pa.concat_arrays([one] * 300)]
    batch = pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "loss_spans"])
    tracemalloc.start()
    (found,) = _read_back([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(found["loss_chars"].to_pylist()) == {1000} and found.num_rows == 300
    assert peak < 8 << 20
