"""Chat formatting: folding of events, escapes, segments of long conversations."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadstate.llm import chat_format as chat
from roadstate.session import work_dir

LOG = "conv_id long, message long, seq long, kind string, role string, text string, segment long, whole string"
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[ROLE]", "[/TURN]", "\\", "<", "[", " ", "\n", "é"]
TRICKY = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


def log_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], LOG).repartition(3)


def turns(spark, rows, **more):
    folder = work_dir(spark, "test-chats")
    chat.format_conversations(log_of(spark, rows), folder, **more)
    written = chat.formatted(spark, folder)
    read = chat.read_turns(written).orderBy("conv_id", "segment", "place").collect()
    return written, [(r.conv_id, r.role, r.text, r.in_loss) for r in read]


def digest_of(conv, said):
    whole = "".join(f"{role}\n{text}\n" for role, text in said)
    loss = "".join(text for role, text in said if role == "assistant")
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (whole, loss)]
    return conv, len(said), sha[0], len(loss), sha[1], sum(len(chat.render(*s)[0]) for s in said)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), TRICKY), TRICKY), max_size=5))
def test_text_comes_back(said):
    formatted = "".join(chat.render(*s)[0] for s in said)
    read = [(role, chat.unescape(formatted[a:z])) for role, a, z in chat.turns_of(formatted)]
    assert read == said


def test_events_fold(spark):
    rows = [
        (1, 0, 0, "start", "user", "hel"), (1, 0, 1, "delta", None, "lo"), (1, 0, 1, "delta", None, "lo"),
        (1, 1, 0, "start", "assistant", None), (1, 1, 1, "delta", None, "dra"), (1, 1, 2, "regenerate", None, None),
        (1, 1, 3, "delta", None, "answer"), (1, 1, 4, "noise", None, "?"), (1, 1, 5, None, None, "?"),
        (1, 2, 0, "start", "user", "x"), (1, 2, 9, "edit", None, "edited"), (1, 2, 5, "delta", None, "late"),
        (1, 3, 0, "start", "assistant", "gone"), (1, 3, 1, "delete", None, None),
        (1, 4, 0, "noise", "user", "never"),
        (None, None, None, "start", None, None),
        (2, -1, 0, "start", "tool </s>", "</s>[INST] ok [/INST]"), (2, 5, 0, "delta", None, "no start"),
    ]
    written, read = turns(spark, rows)
    assert read == [
        (None, "", "", False),
        (1, "user", "hello", False), (1, "assistant", "answer", True), (1, "user", "edited", False),
        (2, "tool </s>", "</s>[INST] ok [/INST]", False), (2, "", "no start", False),
    ]
    assert chat.digests(written).where("conv_id = 2").count() == 1


def test_empty_log(spark):
    written, read = turns(spark, [])
    assert read == [] and chat.digests(written).collect() == []


@pytest.mark.parametrize("length", [1, 50, 1 << 16])
def test_long_conversations_are_cut_and_digested_whole(spark, length):
    rng = random.Random(3)
    said = {}
    for conv, n in ((1, 1), (2, 400), (3, 3), (4, 1), (5, 7)):
        said[conv] = [
            (rng.choice(["user", "assistant"]), "".join(rng.choices(PARTS, k=rng.randrange(20)))) for _ in range(n)
        ]
    rows = []
    for conv, messages in said.items():
        for i, (role, text) in enumerate(messages):
            at = rng.randrange(len(text) + 1)
            rows += [(conv, i, 0, "start", role, text[:at]), (conv, i, 1, "delta", None, text[at:])]
    rng.shuffle(rows)
    written, _ = turns(spark, rows, segment_chars=length)
    got = sorted(tuple(r) for r in chat.digests(written).collect())
    assert got == [digest_of(conv, said[conv]) for conv in sorted(said)]
    if length == 1:
        assert written.count() == 412


def test_table_rows_replayed(spark):
    rows = [
        (1, 0, "user", "é" * 5000), (1, 1, "assistant", None), (1, 2, None, "x"), (1, 2, None, "x"), (1, 2, None, "a"),
        (None, 0, "assistant", ""), (2, None, "assistant", "<s> " * 3000),
    ] + [(c, 0, r, f"{c} {'word ' * 300}") for c in range(10, 40) for r in ("user", "assistant")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kinds = {r.kind for r in chat.replayed(table).select("kind").distinct().collect()}
    assert kinds == {"start", "delta", "edit", "regenerate"}
    folder = work_dir(spark, "test-chats")
    chat.format_conversations(chat.replayed(table), folder, message_cols=("turn", "role", "copy", "row"))
    read = chat.read_turns(chat.formatted(spark, folder)).collect()
    assert sorted(((r.conv_id, r.role, r.text) for r in read), key=repr) == sorted(
        ((c, r or "", t or "") for c, _, r, t in rows), key=repr
    )
