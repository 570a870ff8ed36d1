"""Structured tool calls: reading, linking, repairing and checking them."""

import json

import pytest
from pyspark.sql import functions as F

from colloquy.functions import messages as M
from colloquy.operators import toolcalls as T

CALL = '<tool_call>{"name": "lookup", "arguments": {"q": "x", "n": null}}</tool_call>'
LOOSE = "<tool_call>{'name': 'find', 'arguments': {'q': None, 'ok': True}}</tool_call>"
CHATS = {
    1: [("system", 's <tools>{"name":"lookup"}\n{"name":"find"}</tools>'), ("user", "u"), ("assistant", "go " + CALL + LOOSE), ("tool", "<tool_response>r1</tool_response><tool_response>r2</tool_response>"), ("assistant", "done")],
    2: [("user", "u"), ("assistant", "<tool_call>print(1)</tool_call>"), ("tool", " out "), ("assistant", "fin")],
    3: [("user", "u"), ("tool", "x"), ("assistant", "end")],
    4: [("user", None), ("assistant", None)],
    5: [],
    6: [("user", "u"), ("assistant", CALL), ("tool", "a"), ("tool", "b"), ("assistant", "end")],
}


@pytest.fixture(scope="module")
def chats(spark):
    df = spark.createDataFrame(list(CHATS.items()), "conv_id long, messages array<struct<role:string,content:string>>")
    return df.withColumn("f", T.structured(T.full(F.col("messages")), "python")).withColumn("tools", T.extract_tools(F.col("messages")))


def values(df, column):
    return dict(df.select("conv_id", column.alias("v")).collect())


def test_structured(chats):
    got = values(chats, F.col("f"))
    assert [(m.role, m.content, m.tool_call_id) for m in got[1][2:]] == [("assistant", "go", None), ("tool", "r1", "call_1"), ("tool", "r2", "call_2"), ("assistant", "done", None)]
    calls = got[1][2].tool_calls
    assert [(c.id, c.function["name"], json.loads(c.function.arguments)) for c in calls] == [("call_1", "lookup", {"q": "x", "n": None}), ("call_2", "find", {"q": None, "ok": True})]
    assert json.loads(got[2][1].tool_calls[0].function.arguments) == {"code": "print(1)"}
    assert got[2][2].content == "out" and got[2][2].tool_call_id == "call_1"
    assert [m.content for m in got[4]] == [None, None] and got[5] == []


def test_tools(chats):
    assert values(chats, F.col("tools")) == {1: ['{"name":"lookup"}', '{"name":"find"}'], 2: None, 3: None, 4: None, 5: None, 6: None}
    attached = values(chats, T.with_python_tool(F.col("f"), F.col("tools")))
    assert attached[2] == [T.PYTHON_TOOL] and len(attached[1]) == 2 and attached[6] is None
    shaped = values(chats, F.transform("tools", T.normalized_tool))
    assert json.loads(shaped[1][0]) == {"type": "function", "function": {"name": "lookup", "parameters": {"type": "object", "properties": {}}}}


def test_pending_and_sequence(chats):
    assert values(chats, T.pending_calls(F.col("f"))) == {1: [0, 0, 2, 1, 0, 0], 2: [0, 1, 0, 0], 3: [0, -1, 0], 4: [0, 0], 5: [], 6: [0, 1, 0, -1, 0]}
    assert values(chats, T.sequence_fault(F.col("f"))) == {1: None, 2: None, 3: "seq_invalid", 4: "empty_content", 5: "seq_invalid", 6: "seq_invalid"}


def test_call_checks(chats):
    got = values(chats, T.call_checks(F.col("f"), F.col("tools")))
    assert got == {1: ["null_in_args", "tool_def_bad_shape"], 2: [], 3: ["tool_without_call", "tool_without_id"], 4: [], 5: [], 6: ["null_in_args", "tool_without_call", "tool_without_id"]}


def test_link_and_merge(spark):
    call = lambda id, name="f": (id, "function", (name, "{}"))
    chat = [("user", "u", None, None, None), ("assistant", "text", None, None, None), ("assistant", "", None, [call("own"), call("own"), call("call_7", "g")], None)]
    chat += [("tool", "r", None, None, i) for i in ("call_9", "kept", None, None)]
    df = spark.createDataFrame([(1, chat)], f"conv_id long, m {M.MESSAGES}")
    linked = values(df, T.link_ids(F.col("m")))[1]
    assert [c.id for c in linked[2].tool_calls] == ["own", "call_1", "call_2"]
    assert [(m.tool_call_id, m["name"]) for m in linked[3:]] == [("own", "f"), ("kept", "f"), ("call_2", "g"), (None, None)]
    merged = values(df, T.merge_split_calls(F.col("m")))[1]
    assert [m.role for m in merged] == ["user", "assistant"] + ["tool"] * 4 and merged[1].content == "text" and len(merged[1].tool_calls) == 3


def test_texts(spark):
    one = spark.range(1).withColumnRenamed("id", "conv_id")
    value = lambda c: values(one, c)[0]
    arguments = [value(T.normalized_arguments(F.lit(a))) for a in ('{"a": 1}', "{'a': None, 'b': 2}", " ", "xyz", "[1]")]
    assert [json.loads(a) for a in arguments[2:]] == [{}, {"value": "xyz"}, {"value": "[1]"}]
    assert json.loads(arguments[0]) == {"a": 1} and set(json.loads(arguments[1])) == {"a", "b"}
    assert value(T.wrap_think(F.lit("Okay, I think so.\n\nLet me see.\n\nThe answer is 4.\n\nThanks"))) == "<think>\nOkay, I think so.\n\nLet me see.\n</think>\n\nThe answer is 4.\n\nThanks"
    for kept in ("Plain. The answer is 4.", "Okay, I think.", "Okay.\n\nI think the answer is 4.", ""):
        assert value(T.wrap_think(F.lit(kept))) == kept
    assert value(T.with_reasoning(F.lit(" a "), F.lit(" r "))) == "<think>\nr\n</think>\n\na" and value(T.with_reasoning(F.lit("a"), F.lit(" "))) == "a"
    assert value(T.joined_parts(F.lit("[{'type': 'text', 'text': 'a'}, {'type': 'text', 'text': None}, {'type': 'text', 'text': 'b'}]"))) == "a\nb"
    assert value(T.joined_parts(F.lit("[{'type': 'image', 'text': 'a'}]"))) is None and value(T.joined_parts(F.lit("[1, 2, 3]"))) == "[1, 2, 3]"


def test_unwrapped(spark):
    rows = [(1, [("system", "k"), ("user", "u"), ("assistant", "[{'role': 'human', 'content': 'hi'}, {'role': 'gpt', 'value': 'yo'}]")]), (2, [("user", "u"), ("assistant", "[{'role': 'alien', 'content': 'hi'}]")]), (3, [])]
    df = spark.createDataFrame(rows, "conv_id long, m array<struct<role:string,content:string>>")
    got = values(df, T.unwrapped(F.col("m")))
    assert [tuple(m) for m in got[1]] == [("system", "k"), ("user", "hi"), ("assistant", "yo")]
    assert [tuple(m) for m in got[2]] == rows[1][1] and got[3] == []


def test_arguments_changed(chats):
    got = values(chats, T.map_arguments(F.col("f"), lambda a: F.regexp_replace(a, "print", "echo")))
    assert json.loads(got[2][1].tool_calls[0].function.arguments) == {"code": "echo(1)"}
