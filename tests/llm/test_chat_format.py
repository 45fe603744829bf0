"""Layouts by fingerprint, reversible template, loss mask."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewscope.llm import chat_format as cf

CONTROL = r"\### Assistant: </turn> ok"


def round_trip(spark, chats):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(chats)], f"conv_id bigint, turns {cf.TURNS}")
    out = cf.format_chats(df)
    return out.select("conv_id", cf.read_back(F.col("formatted")).alias("back"),
                      cf.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "loss_spans", "formatted").orderBy("conv_id").collect()


def test_control_strings_survive(spark):
    chats = [
        [("user", CONTROL), ("assistant", CONTROL)], [("assistant", ""), ("assistant", "a: b\\b\\l\\h")], [], None,
        [(None, None), ("we: ird\\c", "### ### </turn>\n#### ")], [("user", "é" * 40000 + "</turn>"), ("assistant", "ü" * 40000)],
    ]
    rows = round_trip(spark, chats)
    for chat, r in zip(chats, rows):
        plain = [(a or "", b or "") for a, b in chat or []]
        assert [tuple(t) for t in r["back"]] == plain
        assert r["loss"] == "".join(b for a, b in plain if a == "assistant")
    assert rows[2]["formatted"] == "" and rows[3]["loss_spans"] == []


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "\\"]), st.text(alphabet="\\#: </turn>\nblhcx", max_size=30)), max_size=4), min_size=20, max_size=20))
def test_any_text_survives(spark, chats):
    for chat, r in zip(chats, round_trip(spark, chats)):
        assert [tuple(t) for t in r["back"]] == chat


def test_json_layouts(spark):
    records = {
        "prompt": {"prompt": "q", "response": "a"}, "question": {"answer": "a", "question": "q"},
        "instruction": {"instruction": "q", "output": "a"},
        "instruction_input": {"instruction": "q", "input": "i", "output": "a"},
        "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        "shared": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "turns": {"turns": [{"role": "user", "text": "q", "turn": 0}, {"turn": 1, "role": "assistant", "text": "a"}]},
        "unknown": {"prompt": "q", "answer": "a"},
    }
    rows = [(k, json.dumps(v)) for k, v in records.items()] + [("unknown", "no json"), ("unknown", None)]
    out = cf.canonical_turns_json(spark.createDataFrame(rows, "name string, body string"), "body").collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["layout"] == r["name"]
        if r["name"] == "unknown":
            assert r["turns"] is None
        else:
            q = "q\n\ni" if r["name"] == "instruction_input" else "q"
            assert [tuple(t) for t in r["turns"]] == [("user", q), ("assistant", "a")]


def test_typed_layouts(spark):
    df = spark.sql("select struct('q' as instruction, 'a' as output) as body, 1 as turns_of, 'x' as layout")
    r = cf.canonical_turns(df, "body").first()
    assert r["layout"] == "instruction" and [tuple(t) for t in r["turns"]] == [("user", "q"), ("assistant", "a")]
    assert cf.canonical_turns(spark.sql("select struct(1 as other) as body"), "body").first()["layout"] == "unknown"


def test_turns_are_ordered_and_gathered(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (None, 0, "user", "n"), (1, 2, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = {r["conv_id"]: [(t["role"], t["text"]) for t in r["chat"]["turns"]] for r in cf.gather_turns(df).collect()}
    assert out[1] == [("user", ""), ("assistant", "a"), ("assistant", "b"), ("user", "c"), ("user", "c")]
    assert out[None] == [("user", "n")]
    assert cf.gather_turns(df.limit(0)).collect() == []
