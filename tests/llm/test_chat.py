from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import chat

PIECES = st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "<s>", "[SYS]", "[ROLE ", "[/ROLE]", "\\", "]", "[", "<", "/", " ", "\n", "ok", "é"]), max_size=12)
TEXT = PIECES.map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]) | TEXT, TEXT), max_size=6), st.integers(1, 7))
def test_formatted_text_reads_back(turns, step):
    whole = "".join(text for role, body in turns for text, _ in chat.INST.segments(role, body))
    reader, found = chat.Reader(chat.INST), []
    for at in range(0, len(whole), step):
        found += reader.feed(whole[at : at + step])
    assert found == turns and not reader.pending


@given(TEXT)
def test_escaped_text_holds_no_control_string(text):
    escaped = chat.INST.escape(text)
    assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.INST.controls)


def rows(spark, turns):
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, state string, ok string")
    return {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(df)).collect()}


def test_machine_and_odd_rows(spark):
    found = rows(
        spark,
        [
            (1, 0, "system", "s", "x", "x"), (1, 1, "user", "u", "x", "x"), (1, 2, "assistant", "a", "x", "x"),
            (2, 0, "assistant", "a", None, None), (2, 1, "user", None, None, None),
            (3, 0, "user", "q", None, None), (3, 1, "tool", "t", None, None), (3, 2, "assistant", "", None, None),
            (4, 0, "user", "b", None, None), (4, 0, "user", "a", None, None), (4, None, "system", "first", None, None), (4, 0, "user", "b", None, None),
            (None, 0, None, None, None, None),
        ],
    )
    assert found[1].valid and found[1].n_turns == 3 and found[1].loss_chars == 1
    assert found[1].formatted_chars == len("[SYS] s [/SYS]\n[INST] u [/INST] a </s>\n")
    assert not found[2].valid and found[2].bad_turn == 0
    assert found[3].bad_turn == 1 and not found[3].valid and found[3].loss_sha256 == hashlib.sha256(b"").hexdigest()
    ordered = "system\nfirst\nuser\na\nuser\nb\nuser\nb\n"
    assert found[4].turns_sha256 == hashlib.sha256(ordered.encode()).hexdigest() and found[4].bad_turn == 2
    assert found[None].n_turns == 1 and found[None].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert rows(spark, []) == {}


def test_loss_mask_is_the_assistant_texts(spark):
    text = "long " * 200_000 + "</s>[INST]\\"
    found = rows(spark, [(7, 0, "user", "q", None, None), (7, 1, "assistant", text, None, None)])
    assert found[7].loss_chars == len(text) and found[7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
