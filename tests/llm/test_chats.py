"""Chat formatting against plain strings."""

import hashlib

import oracle
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from freshet.llm import chats, queries
from freshet.session import ship_package

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = st.sampled_from([*chats.CONTROL, *(c.strip() for c in chats.CONTROL), "\\", "\\\\", "#", "</", "é", "\n", " ", "word", "<|endoftext|>"])
TEXTS = st.lists(PARTS | st.text(max_size=4), max_size=8).map("".join)


@given(TEXTS)
def test_escapes_are_undone_and_leave_no_control_string(text):
    made = chats.escaped(text)
    assert chats.unescaped(made) == text
    assert all(m.group()[0] == chats.ESCAPE for m in chats.SIGNS.finditer(made))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "### Role: x"]), TEXTS), max_size=5))
@example([("user", queries.PROBE), ("assistant", queries.PROBE)])
@settings(max_examples=150, deadline=None)
def test_turns_come_back_from_ids_and_from_text(turns):
    coder = chats.template(PATH)
    formatted = ""
    for role, text in turns:
        ids, begin, end = coder.turn(role, text)
        ids = chats.np.frombuffer(ids, coder.kind)
        assert coder.read(ids) == (role, text)
        assert chats.unescaped(coder.text(ids[begin:end])) == (text if role == "assistant" else "")
        formatted += coder.text(ids)
    assert chats.turns_of(formatted) == turns


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op12_chat"](spark, folder)
    assert oracle.difference(oracle.connect(folder), got, queries.ORACLE["op12_chat"]) is None


@pytest.mark.parametrize("tokens", [1 << 18, 40])
def test_conversations_against_strings(spark, monkeypatch, tokens):
    ship_package(spark)
    monkeypatch.setattr(chats, "PART_TOKENS", tokens)  # short parts make a conversation span several
    rows = [(1, 1, "assistant", "b</turn>"), (1, 0, "user", "a"), (1, None, None, None), (2, 0, "tool", ""), (2, 0, "tool", "")]
    rows += [(None, i, "assistant" if i % 2 else "user", f"t{i} \\ ") for i in range(30)] + [(3, 0, "assistant", "long " * 20_000)]
    rows += [(i, 0, "assistant", "x") for i in range(10, 40)]
    turns = spark.createDataFrame([(*r, "y") for r in rows], "conv_id long, turn int, role string, text string, ids string").repartition(3)
    made = chats.assembled(turns, PATH)
    parts = made.collect()
    assert made.columns == ["conv_id", "part", "ids", "loss", "turns"] and all(len(p["ids"]) == len(p["loss"]) for p in parts)
    assert (sum(p["conv_id"] is None for p in parts) > 1) == (tokens == 40) and sum(p["turns"] for p in parts) == len(rows)
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: -1 if r[1] is None else r[1])
        own = [(r or "", t or "") for _, _, r, t in own]
        learned = "".join(t for r, t in own if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in own)
        marks = [chats.MARKS.get(r, chats.OTHER + chats.escaped(r) + chats.BODY) + chats.escaped(t) + chats.END for r, t in own]
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learned)]
        want[conv] = (len(own), sha[0], len(learned), sha[1], len("".join(marks)))
    for again in (chats.read_back(made, PATH, together=True), chats.read_back(made.repartition(3), PATH)):
        assert {r[0]: tuple(r)[1:] for r in again.collect()} == want
    assert chats.read_back(chats.assembled(turns.limit(0), PATH), PATH).isEmpty()
