from hashlib import sha256

import numpy as np
from hypothesis import given, strategies as st

from adlumen.llm import chat
from adlumen.llm.queries import QUERIES, TOKENIZER
from tests.llm import brute

MARKS = st.lists(st.sampled_from(["<", "|", "\\", "[", "]", "s>", "/s>", "INST]", "/INST]", "turn|>", "a", "\n"]), max_size=12).map("".join)


@given(MARKS)
def test_escapes_are_reversible_and_hide_marks(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in (*chat.CONTROL, "</s>", "<s>", "[INST]", "[/INST]"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", None, "<|end|>"]), st.one_of(st.none(), MARKS)), max_size=5))
def test_turns_come_back(turns):
    text, _ = chat.render(turns)
    assert chat.turns_of(text) == [(r or "", t or "") for r, t in turns]


@given(st.lists(st.integers(1, 5), max_size=12), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 4)), max_size=4))
def test_binary_search_finds_the_tokens_of_spans(sizes, spans):
    ends = np.cumsum(np.array(sizes, dtype=np.int64))
    starts = ends - np.array(sizes, dtype=np.int64)
    at, cut = 0, []
    for skip, size in spans:
        cut.append((at + skip, at + skip + size))
        at = cut[-1][1]
    want = [any(s < e2 and s2 < e for s2, e2 in cut if e2 > s2) for s, e in zip(starts, ends)]
    assert chat.tokens_in(cut, starts, ends).tolist() == want


def expect(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha256(said.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest()


def test_query_gives_every_conversation_back(spark, small):
    got = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op8_chat_masks"](spark, small).collect()}
    turns = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(brute.rows(small, "conversations"), key=lambda r: (r["conv_id"], r["turn"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {c: expect(t) for c, t in turns.items()}


def test_nulls_ties_long_and_empty(spark):
    long = "é <|turn|> " * 20_000
    kind = "conv_id long, turn long, role string, text string, formatted int, ids string"
    rows = [(1, 0, "user", None), (1, 1, "assistant", long), (1, 1, "assistant", long), (1, None, None, "first"),
            (None, 0, "assistant", ""), (2, 0, "assistant", "x")]
    given_ = spark.createDataFrame([(*r, 0, "") for r in rows], kind)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_chats(given_, TOKENIZER)).collect()}
    assert got == {1: expect([(None, "first"), ("user", None), ("assistant", long), ("assistant", long)]),
                   None: expect([("assistant", "")]), 2: expect([("assistant", "x")])}
    assert chat.read_back(chat.format_chats(given_.limit(0), TOKENIZER)).count() == 0
