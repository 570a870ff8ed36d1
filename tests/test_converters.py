"""Converters on one row of each source."""

import pytest

from colloquy.operators.converters import CONVERTERS, convert, longest_sessions, report

CHAT = "array<struct<role:string,content:string>>"
QA = [("human", "q"), ("gpt", "a")]


@pytest.mark.parametrize(
    ("name", "schema", "row", "expected"),
    [
        ("standard", f"messages {CHAT}", (QA,), [("user", "q"), ("assistant", "a")]),
        ("standard", f"messages {CHAT}", ([("human", "q")],), "skip_empty_or_invalid"),
        ("resolved_trajectories", f"messages {CHAT}, resolved boolean", (QA, False), "skip_not_resolved"),
        ("rewarded_trajectories", f"messages {CHAT}, reward double", (QA, None), "skip_partial_round_prefix"),
        ("rewarded_trajectories", f"messages {CHAT}, reward double", (QA, 0.5), "skip_reward_not_1"),
        ("scored_tool_chats", "messages string, response_quality_assessment string", ('[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]', '{"overall_score": 4.5}'), [("user", "q"), ("assistant", "a")]),
        ("scored_tool_chats", "messages string, response_quality_assessment string", ("[]", '{"overall_score": 3}'), "skip_quality_below_4"),
        ("preferred", f"chosen {CHAT}", (QA,), [("user", "q"), ("assistant", "a")]),
        ("instruction_input", "instruction string, input string, output string", ("do", "x", "y"), [("user", "do\n\nInput: x"), ("assistant", "y")]),
        ("instruction_input", "instruction string, input string, output string", ("do", "N/A", "y"), [("user", "do"), ("assistant", "y")]),
        ("instruction_as_system", "instruction string, input string, output string", ("do", "x", "y"), [("system", "do"), ("user", "x"), ("assistant", "y")]),
        ("multiple_choice", "question string, options array<string>, rationale string, correct string", ("q", ["A)1", "B)2"], "since", "B"), [("user", "q\n\nOptions:\nA)1\nB)2"), ("assistant", "since\n\nAnswer: B")]),
        ("code_solutions", "description string, solutions struct<language:array<int>,solution:array<string>>", ("d", ([1, 2, 3], ["old", "cpp", "py "])), [("user", "d"), ("assistant", "```python\npy\n```")]),
        ("code_solutions", "description string, solutions struct<language:array<int>,solution:array<string>>", ("d", ([1], ["old"])), "skip_no_solution"),
        ("plot_questions", "plot string, question string, answers array<string>, no_answer boolean", ("p", "q", ["", "a"], False), [("user", "Read the following movie plot and answer the question.\n\nPlot:\np\n\nQuestion: q"), ("assistant", "a")]),
        ("inst_prompt", "prompt string, answer string", ("[INST]<<SYS>>s<</SYS>>u[/INST]", "a"), [("system", "s"), ("user", "u"), ("assistant", "a")]),
        ("inst_prompt", "prompt string, answer string", ("u", "a"), "skip_unparsed_prompt"),
        ("marked_chat", "system string, chat string", ("SYSTEM: s", "USER: u\nASSISTANT: a <|endoftext|>"), [("system", "s"), ("user", "u"), ("assistant", "a")]),
        ("spans", "spans array<struct<attributes:map<string,string>>>", ([({"input.messages": '[{"role":"user","content":"q"}]', "output.value": "a"},), ({"input.messages": "[]", "output.value": "b"},)],), [("user", "q"), ("assistant", "a")]),
    ],
)
def test_convert(spark, name, schema, row, expected):
    got = convert(spark.createDataFrame([row], schema), name).first()
    assert (got.skip if isinstance(expected, str) else [tuple(m) for m in got.messages]) == expected


def test_registry_and_report(spark):
    assert all(c.columns for c in CONVERTERS.values())
    df = spark.createDataFrame([("q", "a"), ("q", None)], "question string, answer string")
    assert sorted((r.outcome, r.n, r.pct) for r in report(convert(df, "question_answer")).collect()) == [("kept", 1, 50.0), ("skip_empty_or_invalid", 1, 50.0)]
    assert convert(df, "nothing").first().skip == "unknown source"


def test_longest_sessions(spark):
    rows = [([("user", "q"), ("assistant", "a")],), ([("user", "q"), ("assistant", "a"), ("user", "more")],), ([("user", "other")],)]
    got = longest_sessions(spark.createDataFrame(rows, f"messages {CHAT}")).collect()
    assert sorted(len(r.messages) for r in got) == [1, 3]
