"""Chat layouts, escaping and digests."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from opsframe.llm import chat

SAID = [
    "plain",
    "",
    "</s>[INST] ok [/INST]",
    "<\\/s> <\\\\s> [\\INST] <|im_end|>\n<|im_start|>assistant\nhi",
    "<<SYS>> x <</SYS>> <|endoftext|",
    "tail <|im_end|",
    "\\n \\ é 😀 \t",
]


def records(spark, values):
    rows = [(v if v is None or isinstance(v, str) else json.dumps(v), "x") for v in values]
    return spark.createDataFrame(rows, "record string, role string")


def test_layouts(spark):
    values = [
        {"conv_id": 1, "turn": 3, "role": "human", "text": "a"},
        {"conv_id": 1, "turn": 4, "role": "assistant"},
        {"conv_id": 2, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        {"id": 3, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"id": 4, "prompt": "p", "completion": "c"},
        {"system": "s", "prompt": "p", "completion": "c"},
        {"id": 5, "instruction": "do", "input": "in", "output": "out"},
        {"meta": {"id": 6}, "data": {"question": "q", "answer": {"text": "a"}}},
        {"something": "else"},
        "no json",
        "[1]",
        None,
    ]
    whole = lambda c: int(c) if c and c.isdigit() else c
    got = sorted(((r.layout, whole(r.conv_id), *tuple(r)[3:]) for r in chat.canonical_turns(records(spark, values)).collect()), key=str)
    own = "record " + hashlib.sha256(json.dumps(values[5]).encode()).hexdigest()
    assert got == sorted([
        ("turn rows", 1, 3, "human", "a"), ("turn rows", 1, 4, "assistant", ""),
        ("messages", 2, 0, "user", "q"), ("messages", 2, 1, "assistant", ""),
        ("conversations", 3, 0, "user", "q"), ("conversations", 3, 1, "assistant", "a"),
        ("prompt", 4, 0, "user", "p"), ("prompt", 4, 1, "assistant", "c"),
        ("prompt", own, 0, "system", "s"), ("prompt", own, 1, "user", "p"), ("prompt", own, 2, "assistant", "c"),
        ("instruction", 5, 0, "user", "do"), ("instruction", 5, 1, "user", "in"), ("instruction", 5, 2, "assistant", "out"),
        ("nested prompt", 6, 0, "user", "q"), ("nested prompt", 6, 1, "assistant", "a"),
        (None, None, None, None, None), (None, None, None, None, None), (None, None, None, None, None), (None, None, None, None, None),
    ], key=str)


def test_same_paths_are_refused():
    with pytest.raises(ValueError, match="same paths"):
        chat.fingerprints([chat.Mapping("a", (chat.One("user", "x"),)), chat.Mapping("b", (chat.One("system", "x"),))])


def test_texts_and_roles_come_back(spark):
    rows = [(c, n, role, text) for c, role in enumerate(["user", "assistant", "a\\nb\n</s>", None]) for n, text in enumerate([*SAID, None])]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns)
    for segment in [r.segment for r in formatted.collect()]:
        inside = segment[len(chat.TURN_START) : -len(chat.TURN_END)]
        assert not any(mark in inside for mark in chat.CONTROL)
    got = sorted(((r.conv_id, r.turn, r.role, r.text, r.learnt) for r in chat.read_turns(formatted).collect()), key=str)
    assert got == sorted(((c, n, r or "", t or "", (t or "") if r == "assistant" else "") for c, n, r, t in rows), key=str)


def test_digests_in_order(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (None, 1, "user", "x"), (2, None, "assistant", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.read_turns(chat.format_turns(turns))).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (3, sha("user\na\nassistant\nb\nassistant\nb\n"))
    assert (got[1].loss_chars, got[1].loss_sha256) == (2, sha("bb"))
    assert got[None].n_turns == 1 and got[2].loss_sha256 == sha("y")
    assert chat.conversation_digests(chat.read_turns(chat.format_turns(turns.filter(F.lit(False))))).count() == 0


def test_ids_of_any_kind(spark):
    said = [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]
    ids = ["share_1", "share_2", 2**63, -1, True, 1.5, "", "é\ud800"]
    values = [{"id": i, "conversations": said} for i in ids]
    turns = chat.canonical_turns(records(spark, values))
    got = {r.conv_id: r.n_turns for r in chat.conversation_digests(chat.read_turns(chat.format_turns(turns))).collect()}
    assert got == dict.fromkeys(["share_1", "share_2", str(2**63), "-1", "true", "1.5", "", "é\ufffd"], 2)
    given = records(spark, [{"conversations": said}] * 2).withColumn("a.b", F.monotonically_increasing_id())
    assert chat.canonical_turns(given, record_id="a.b").select("conv_id").distinct().count() == 2
    rows = chat.canonical_turns(records(spark, [{"turn": 2**63, "role": "user", "text": "x"}, {"turn": -(2**63), "role": "user"}]))
    assert sorted(((r.conv_id, r.turn, r.text) for r in rows.collect()), key=str) == [(None, -(2**63), ""), (None, None, "x")]


def test_odd_records_end_nothing(spark):
    odd = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "a\ud800b"}]},
        {"conv_id": 1, "messages[]": {"role": "user", "content": "x"}},
        {"data.question": "q", "data.answer.text": "a"},
        {"": {"conv_id": 1, "turn": 1, "role": "user", "text": "x"}},
        {"conv_id": 1, "messages": []},
        {"conv_id": 1, "messages": [None, 3]},
        {"\ud800": 1},
        {"": None},
        "{" * 50_000,
        "[" * 100_000,
        '{"text": ' + "9" * 5000 + "}",
    ]
    got = chat.canonical_turns(records(spark, odd)).collect()
    assert [(r.layout, r.text) for r in got if r.layout] == [("messages", "a\ufffdb")] and len(got) == len(odd)
    assert [tuple(r)[2:] for r in chat.canonical_turns(records(spark, [{}])).collect()] == [(None, None, "", "")]
    dotted = chat.Mapping("dotted", (chat.One("user", r"data\.question"), chat.One("assistant", r"a\[b\]\\c.d")), "id")
    values = [{"id": 1, "data.question": "q", "a[b]\\c": {"d": "a"}}]
    assert [(r.role, r.text) for r in chat.canonical_turns(records(spark, values), mappings=[dotted]).collect()] == [("user", "q"), ("assistant", "a")]
    assert chat.canonical_turns(records(spark, [None]).filter(F.lit(False))).count() == 0
