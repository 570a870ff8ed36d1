"""Chats recovered from other notations, dropped context put back, and sums checked.

Parsers give arrays of role and content, null unless both a user and an assistant speak.
"""

from __future__ import annotations

import ast
import operator
import re
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.text import is_blank, let, strip
from .normalize import usable

THOUGHT = r"(?is)<think>(.*?)</think>"
ANSWER = r"(?is)<answer>(.*?)</answer>"
USER_LINE = r"(?:^|\n)\s*User\s*:\s*"
INST_SYSTEM = r"(?s)<<SYS>>\s*(.*?)\s*<</SYS>>\s*\n*"
INST_TURN = r"(?s)\[INST\]\s*(.*?)\s*\[/INST\]\s*(.*?)(?=\[INST\]|\z)"


def _said(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _spoken(messages: Column) -> Column:
    return let(F.filter(messages, lambda m: ~is_blank(F.coalesce(m.content, F.lit("")))), lambda m: F.when(usable(m), m))


def bracketed(text: Column) -> Column:
    """Messages of ``User: question``, each with its reply in brackets after an empty line.

    Of a reply with thought or answer tags only those are kept, the thought in its tags.
    """

    def body(reply: Column) -> Column:
        thought = F.when(reply.rlike(THOUGHT), F.concat(F.lit("<think>"), strip(F.regexp_extract(reply, THOUGHT, 1)), F.lit("</think>")))
        answer = F.when(reply.rlike(ANSWER), strip(F.regexp_extract(reply, ANSWER, 1)))
        return F.when(thought.isNull() & answer.isNull(), strip(reply)).otherwise(F.array_join(F.array_compact(F.array(thought, answer)), "\n\n"))

    def turn(chunk: Column) -> Column:
        place = F.locate("\n\n[", chunk)
        question = F.when(place > 0, F.left(chunk, place - 1)).otherwise(chunk)
        reply = F.when(place > 0, F.regexp_replace(F.substr(chunk, place + 3), r"\s*\]*\s*\z", "")).otherwise(F.lit(""))
        return F.array(_said("user", strip(question)), _said("assistant", body(reply)))

    chunks = F.filter(F.split(text, USER_LINE), lambda c: ~is_blank(c))
    return F.when(text.contains("User:"), _spoken(F.flatten(F.transform(chunks, turn))))


def inst(text: Column) -> Column:
    """Messages of ``[INST]`` turns; the first system block that says something stands first."""
    asked = F.regexp_extract_all(text, F.lit(INST_TURN), F.lit(1))
    replies = F.regexp_extract_all(text, F.lit(INST_TURN), F.lit(2))
    systems = F.filter(F.transform(asked, lambda a: strip(F.regexp_extract(a, INST_SYSTEM, 1))), lambda s: s != "")
    clean = lambda r: strip(F.regexp_replace(strip(F.regexp_replace(r, r"</s>\s*\z", "")), r"\A<s>\s*", ""))

    def over(x: Column) -> Column:
        turns = F.transform(x.asked, lambda a, i: F.array(_said("user", strip(F.regexp_replace(a, INST_SYSTEM, ""))), _said("assistant", clean(F.get(x.replies, i)))))
        return _spoken(F.concat(F.array(_said("system", F.get(x.systems, F.lit(0)))), F.flatten(turns)))

    marked = text.contains("[INST]") & text.contains("[/INST]")
    return F.when(marked, let(F.struct(asked.alias("asked"), replies.alias("replies"), systems.alias("systems")), over))


def with_context(messages: Column, *dropped: Column) -> Column:
    """Messages whose first user turn follows the texts of dropped columns; short texts and bare numbers are no context."""
    real = F.filter(F.transform(F.array(*dropped), strip), lambda c: c.isNotNull() & (F.length(c) > 20) & ~c.rlike(r"\A\p{Nd}+\z"))
    context = F.array_join(real, "\n\n")
    first = F.array_position(F.transform(messages, lambda m: m.role), "user")
    asked = lambda m: F.struct(m.role.alias("role"), F.concat(F.lit("Context: "), context, F.lit("\n\nQuestion: "), F.coalesce(m.content, F.lit(""))).alias("content"))
    plain = lambda m: F.struct(m.role.alias("role"), m.content.alias("content"))
    return F.when(F.size(real) > 0, F.transform(messages, lambda m, i: F.when(i + 1 == first, asked(m)).otherwise(plain(m)))).otherwise(messages)


_OPERATIONS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}
_SUM = re.compile(r"[\d\s.+*/()-]{1,200}")


def _value(node: ast.AST) -> Fraction:
    if isinstance(node, ast.BinOp) and type(node.op) in _OPERATIONS:
        return _OPERATIONS[type(node.op)](_value(node.left), _value(node.right))
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.UAdd, ast.USub)):
        return _value(node.operand) * (-1 if isinstance(node.op, ast.USub) else 1)
    if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
        return Fraction(node.value)
    raise ValueError("no arithmetic")


def reaches(expression: str, numbers: list[int], target: int) -> bool:
    """Whether an expression uses exactly these numbers and has this value; what is no arithmetic does not."""
    text = expression.split("=")[0].strip()
    if not _SUM.fullmatch(text) or sorted(Fraction(n) for n in re.findall(r"\d+(?:\.\d+)?", text)) != sorted(map(Fraction, numbers)):
        return False
    try:
        return abs(_value(ast.parse(text, mode="eval").body) - target) < Fraction(1, 10**6)
    except (ValueError, SyntaxError, ZeroDivisionError, RecursionError, MemoryError):
        return False


@F.pandas_udf(BooleanType())
def countdown_holds(expressions: pd.Series, numbers: pd.Series, targets: pd.Series) -> pd.Series:
    """Whether each expression makes its target of its numbers. Arithmetic of any shape needs Python here."""
    rows = zip(expressions, numbers, targets)
    return pd.Series([e is not None and n is not None and not pd.isna(t) and reaches(e, list(n), int(t)) for e, n, t in rows], dtype=bool)
