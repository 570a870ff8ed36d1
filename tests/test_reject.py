"""Ordered rejection, loops and audit checks on rows that the generated tables do not hold."""

import pytest
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import dedup, rules
from tests.test_rules import A, S, U, chats

GREEK = "".join(chr(0x3B1 + i % 24) for i in range(24))
CASES = [
    ([U("q"), A("a")], None),
    ([U("q"), A("<think> . . . </think> yes")], "think_junk"),
    ([U("q"), A("<think>\n</think>\nHello")], "think_empty"),
    ([U("q"), A("<think>None</think> Hello")], "think_empty"),
    ([U("q"), A("<think><think>some reason</think></think>\nans")], None),
    ([U("q"), A("<think><think> A reason </think> ar.</think> ar.")], None),
    ([U("q"), A("<think>never closed")], "think_unbalanced"),
    ([U("q"), A("<think>only a thought</think>")], "think_no_answer"),
    ([S("<think> is how to think"), U("q"), A("a")], None),
    ([U("q"), A("None")], "placeholder_answer"),
    ([U("q"), A("梦" * 300)], "single_char_run"),
    ([U("q"), A("ok " + ". " * 60 + "done")], "dot_run"),
    ([U("q"), A("bad �")], "control_or_replacement_char"),
    ([U("q"), A("a"), U("b")], "seq_invalid"),
    ([U("q"), A("this is one sentence that comes again and again here. " * 60)], "repetition_loop"),
    ([U("q"), A("+ 7 + 0 " * 60)], None),
    ([U("q"), A(GREEK.replace(" ", "") * 30)], "repetition_loop"),
    ([U("Write an educational piece related to the following text snippet:"), A("a")], "prompt_missing_payload"),
    ([U("What is in <image> ?"), A("a")], "missing_context_placeholder"),
    ([U("Fold <protein> MKTAYIAKQRQISFVKSHFSRQ"), A("a")], None),
    ([U("Name <smiles> CC(=O)OC1=CC=CC=C1"), A("a")], None),
    ([U("html `<image>` tag"), A("a")], None),
    ([U("tell me how the man went to the"), A("Your question seems incomplete, but here")], "missing_context_cutoff"),
    ([U("tell me how the man went to the"), A("He walked")], None),
    ([U("q <|im_start|>"), A("a")], "special_token_in_text"),
    ([U("q"), A("a<|im_end|>")], None),
    ([U("q"), ("tool", "r"), A("a")], "tool_result_without_call"),
    ([U("q"), A('<tool_call>{"name": "f"}</tool_call>'), ("tool", "r"), A("a")], None),
    ([U("q"), A("<tool_call>assistant")], "tool_call_unbalanced"),
    ([U("q"), A("<tool_call>print(1)</tool_call>"), ("tool", "r"), A("a")], "tool_call_unparseable"),
    ([S("You have access to the following functions"), U("q"), A("I will call `lookup` now")], "tool_call_dropped"),
    ([("alien", "q"), A("a")], "bad_role"),
    ([("human", "q"), ("gpt", "a")], None),
    ([S(" "), U("q"), A("a")], None),
    ([U("q"), A(" ")], "empty_content"),
    ([], "no_messages"),
]


def test_reject(spark):
    rows = chats(spark, *(m for m, _ in CASES)).select("conv_id", rules.reject_reason(F.col("messages")).alias("r")).collect()
    assert {r.conv_id: r.r for r in rows} == {i: x for i, (_, x) in enumerate(CASES)}


def test_lexical(spark):
    question = "which famous river flows through several european capitals before reaching another large inland body"
    answer = "bananas contain plenty minerals while growers harvest them green, ship crates overseas, ripen slowly using ethylene, display neatly stacked, sell quickly, peel easily, taste sweet, feed millions daily"
    rows = chats(spark, [U(question), A(answer)], [U(question), A(answer + " river")])
    assert [r[0] for r in rows.select(rules.reject_reason(F.col("messages"), lexical=True)).collect()] == ["qa_no_word_overlap", None]


def test_filter_loops_and_tools(spark):
    phrase = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo "
    rows = chats(spark, [U("q"), A(phrase * 25)], [U("q"), A(phrase * 5)], [U("q"), ("tool", "r"), A("a")], [U("q"), A("<tool_call>x</tool_call>"), ("tool", "r"), ("tool", "s"), A("a")])
    assert [r[0] for r in rows.select(rules.filter_reasons(F.col("messages"))).collect()] == [["phrase_loop"], [], ["tool_result_without_call"], []]


def test_audit_prompts(spark):
    rows = chats(
        spark,
        [U("Question: why?\nAnswer: because it is so and not otherwise"), A("a")],
        [U("Question: why?\nAnswer:"), A("a")],
        [U("Question: a\nAnswer: first of several answers\nQuestion: b\nAnswer: second of several answers"), A("a")],
        [U("solve it"), A("<think>The user wants me to create a new problem</think> done")],
        [U("create a problem"), A("<think>The user wants me to create a new problem</think> done")],
    )
    got = [r[0] for r in rows.select(rules.audit_checks(F.col("messages"))).collect()]
    assert got == [["answer_in_prompt"], [], [], ["think_is_problem_creation"], []]


@pytest.mark.parametrize("text", ["a b a b a b c", "", "one", "x x x y y z " * 3, "q w e r t y"])
def test_most_frequent(spark, text):
    """Counts and first places of n-grams against a plain count."""
    from collections import Counter

    w = text.split()
    grams = [tuple(w[i : i + 2]) for i in range(len(w) - 1)]
    got = spark.createDataFrame([(text,)], "t string").select(T.top_grams(T.words(F.col("t")), 2, 3)).first()[0]
    assert [(r.times, tuple(r.gram)) for r in got] == [(n, g) for g, n in sorted(Counter(grams).items(), key=lambda x: (-x[1], grams.index(x[0])))[:3]]


def test_loops_in_row(spark):
    rows = [(1, "one two three four five six seven eight nine ten eleven " * 20), (2, "1 2 3 4 5 6 7 8 9 0 " * 30), (3, None), (4, "short")]
    got = dedup.phrase_loops(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()
    assert [(r.id, r.times) for r in got] == [(1, 20)]
