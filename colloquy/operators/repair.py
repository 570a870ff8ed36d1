"""Repairs that keep a chat: tags, roles, tool calls, and how often each applied."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import messages as M
from ..functions.text import is_blank, strip
from .rules import END_TOKENS, collapsed_think

# Bodies that count as no thought.
EMPTY_THINK = r"(?is)<think>\s*(?:none|null|n/a|nan)?\s*</think>\s*"


def _content(messages: Column, role: str | None, change) -> Column:
    return F.transform(messages, lambda m: F.struct(m.role.alias("role"), (F.when(m.role == role, change(m.content)).otherwise(m.content) if role else change(m.content)).alias("content")))


def canonical_roles(messages: Column) -> Column:
    return F.transform(messages, lambda m: F.struct(F.coalesce(M.canonical_role(m.role), m.role).alias("role"), m.content.alias("content")))


REPAIRS = {
    "role_renamed": canonical_roles,
    "empty_system_dropped": lambda m: F.filter(m, lambda x: (x.role != "system") | ~is_blank(x.content)),
    "special_token_end_stripped": lambda m: _content(m, None, lambda c: F.regexp_replace(c, END_TOKENS, "")),
    "duplicate_think_tag_collapsed": lambda m: _content(m, "assistant", collapsed_think),
    "empty_think_stripped": lambda m: _content(m, "assistant", lambda c: F.regexp_replace(c, EMPTY_THINK, "")),
    "answer_tag_unwrapped": lambda m: _content(m, "assistant", lambda c: F.when(c.rlike("(?i)</?answer>"), strip(F.regexp_replace(c, "(?i)</?answer>", ""))).otherwise(c)),
    "trailing_turns_trimmed": lambda m: M.trim_to_last(m, "assistant"),
}


def repair(chats: DataFrame, names: list[str] | None = None) -> DataFrame:
    """chats with repaired messages and the names of the repairs that changed something."""
    out = chats.withColumn("repairs", F.array().cast("array<string>"))
    for name in names or list(REPAIRS):
        out = out.withColumn("_new", REPAIRS[name](F.col("messages")))
        out = out.withColumn("repairs", F.when(F.col("_new").eqNullSafe(F.col("messages")), F.col("repairs")).otherwise(F.array_append("repairs", F.lit(name))))
        out = out.withColumn("messages", F.col("_new")).drop("_new")
    return out


_CALL = re.compile(r"<tool_call>\s*(.*?)\s*</tool_call>", re.S)


def _calls(text: str | None) -> str | None:
    """Tool calls written in a text, as a JSON list; null unless every block holds one."""
    if text is None or "<tool_call>" not in text or text.count("<tool_call>") != text.count("</tool_call>"):
        return None
    out = []
    for place, body in enumerate(_CALL.findall(text)):
        try:
            call = json.loads(body)
            name = call["name"]
        except (ValueError, KeyError, TypeError):
            return None
        arguments = call.get("arguments", {})
        out.append({"id": f"call_{place}", "type": "function", "function": {"name": name, "arguments": arguments if isinstance(arguments, str) else json.dumps(arguments)}})
    return json.dumps(out)


@F.pandas_udf(StringType())
def tool_calls_json(texts: pd.Series) -> pd.Series:
    return texts.map(_calls)


CALLS = "array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"


def tool_calls(text: Column) -> Column:
    """Structured calls of an assistant text in <tool_call> blocks. JSON of any shape needs Python here."""
    return F.from_json(tool_calls_json(text), CALLS)


def link_tool_replies(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, call_turn: each tool reply with the assistant turn it answers.

    The i-th reply after an assistant turn answers its i-th call; replies beyond its
    calls (n_calls) become user turns with no call.
    """
    from pyspark.sql import Window as W

    w = W.partitionBy("conv_id").orderBy("turn")
    marked = turns.withColumn("call_turn", F.last(F.when(F.col("role") != "tool", F.col("turn")), True).over(w))
    group = W.partitionBy("conv_id", "call_turn").orderBy("turn")
    marked = marked.withColumns({"_place": F.sum((F.col("role") == "tool").cast("int")).over(group), "_calls": F.max(F.when(F.col("turn") == F.col("call_turn"), F.col("n_calls"))).over(W.partitionBy("conv_id", "call_turn"))})
    fits = (F.col("role") == "tool") & (F.col("_place") <= F.coalesce("_calls", F.lit(0)))
    return marked.select("conv_id", "turn", F.when((F.col("role") == "tool") & ~fits, F.lit("user")).otherwise(F.col("role")).alias("role"), F.when(fits, F.col("call_turn")).alias("call_turn"))
