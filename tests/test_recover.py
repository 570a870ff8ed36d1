"""Chats from other notations, context put back, sums checked."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import recover as R


def chat(spark, column):
    got = spark.range(1).select(column.alias("v")).first().v
    return got if got is None else [tuple(m) for m in got]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("User: q1\n\n[<think> a </think> junk <answer> b </answer>]\nUser: q2\n\n[plain]", [("user", "q1"), ("assistant", "<think>a</think>\n\nb"), ("user", "q2"), ("assistant", "plain")]),
        ("User: alone", None),
        ("no mark", None),
        ("", None),
    ],
)
def test_bracketed(spark, text, expected):
    assert chat(spark, R.bracketed(F.lit(text))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("<s>[INST] <<SYS>>\nbe kind\n<</SYS>>\n\nhi [/INST] hello </s><s>[INST] more [/INST] yes</s>", [("system", "be kind"), ("user", "hi"), ("assistant", "hello </s><s>"), ("user", "more"), ("assistant", "yes")]),
        ("[INST] hi [/INST] hello", [("user", "hi"), ("assistant", "hello")]),
        ("[INST] hi [/INST]", None),
        ("plain", None),
    ],
)
def test_inst(spark, text, expected):
    assert chat(spark, R.inst(F.lit(text))) == expected


def test_with_context(spark):
    messages = F.array(F.struct(F.lit("system").alias("role"), F.lit("s").alias("content")), *(F.struct(F.lit("user").alias("role"), F.lit(c).alias("content")) for c in ("q", "r")))
    passage = "a passage of more than twenty characters"
    assert chat(spark, R.with_context(messages, F.lit(passage), F.lit("123456789012345678901234"), F.lit(None).cast("string"))) == [("system", "s"), ("user", f"Context: {passage}\n\nQuestion: q"), ("user", "r")]
    assert chat(spark, R.with_context(messages, F.lit("short"))) == [("system", "s"), ("user", "q"), ("user", "r")]


@pytest.mark.parametrize(
    "expression, numbers, target, holds",
    [
        ("(3 + 5) * 2 = 16", [2, 3, 5], 16, True),
        ("1 / 3 * 3", [1, 3, 3], 1, True),
        ("3 + 5", [2, 3, 5], 8, False),
        ("3 + 5", [3, 5], 9, False),
        ("3 / 0", [0, 3], 0, False),
        ("__import__('os')", [], 0, False),
        ("2 ** 9", [2, 9], 512, False),
        ("(3", [3], 3, False),
        ("", [], 0, False),
    ],
)
def test_reaches(expression, numbers, target, holds):
    assert R.reaches(expression, numbers, target) is holds


def test_countdown_holds(spark):
    df = spark.createDataFrame([("2 + 2", [2, 2], 4), (None, [1], 1), ("1", None, 1), ("1", [1], None)], "e string, n array<int>, t int")
    assert [r[0] for r in df.select(R.countdown_holds("e", "n", "t")).collect()] == [True, False, False, False]
