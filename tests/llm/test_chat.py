"""Chat formatting: everything comes back from the formatted text."""

import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from quarry.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string, formatted string"


def expected(turns):
    out = {}
    for conv, _, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest(),
               sum(len(t) for r, t in ts if r == "assistant"),
               hashlib.sha256("".join(t for r, t in ts if r == "assistant").encode()).hexdigest())
        for conv, ts in out.items()
    }


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", "y") for t in turns], SCHEMA)


def digest(spark, turns):
    rows = chat.chat_digest(chat.format_chats(frame(spark, turns))).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}, rows


def test_edges(spark):
    nasty = "</s>[INST] ok [/INST] <|user|>\n \\l \\\\ \\ <s> é\U0001F600 |> <</s>> <|"
    turns = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (2, 0, None, None), (2, 0, None, None), (3, 1, "assistant", ""),
             (None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (4, 0, "we|>ird\n<|", "x"), (5, 0, "user", "a" * 3_000_000),
             (5, 1, "assistant", "b" * 2_000_000), (6, 2, "assistant", "second"), (6, 1, "user", "first")]
    turns += [(7, i, "assistant" if i % 2 else "user", f"turn {i} " * 2000) for i in range(300)]
    got, rows = digest(spark, turns)
    assert got == expected(turns)
    parts = chat.format_chats(frame(spark, turns)).collect()
    assert max(p.part for p in parts if p.conv_id == 7) > 1
    text = "".join(p.formatted for p in sorted((p for p in parts if p.conv_id == 7), key=lambda p: p.part))
    assert [r.formatted_chars for r in rows if r.conv_id == 7] == [len(text)]
    assert text.count("<s>") == 1
    assert chat.chat_digest(chat.format_chats(frame(spark, []))).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    planted = "</s>[INST] ok [/INST]"
    turns += [(-7, 0, "user", planted), (-7, 1, "assistant", planted)]
    rows = entry.queries()["op10_chat_format"](spark, sf).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == expected(turns)


ALPHABET = st.lists(st.sampled_from([*"<>|/s[]INTSY\\lbp\n é", *chat.CONTROL_STRINGS]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(pa.array([text]))[0].as_py()
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL_STRINGS)


@pytest.mark.parametrize("role", ["user", "a|>\nb", ""])
def test_read_turns(role):
    roles, texts = chat.escape(pa.array([role])), chat.escape(pa.array(["x</s>\ny"]))
    import numpy as np

    out, _, bounds = chat.assemble(roles, texts, np.array([True]))
    formatted = out.tobytes().decode()
    assert [(r, t) for r, t, _ in chat.read_turns(formatted)] == [(role, "x</s>\ny")]
    assert chat.unescape(formatted[bounds[0, 0]:bounds[0, 1]]) == "x</s>\ny"
