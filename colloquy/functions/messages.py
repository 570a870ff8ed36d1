"""Chats as arrays of messages, and expressions over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import is_blank, strip

MESSAGE = "struct<role:string,content:string,name:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,tool_call_id:string>"
MESSAGES = f"array<{MESSAGE}>"

#: The roles, and other names for them.
ROLES = ["system", "user", "assistant", "tool"]
ROLE_NAMES = {
    "system": "system", "user": "user", "assistant": "assistant", "tool": "tool",
    "human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "function": "tool", "observation": "tool",
}


def from_turns(turns: DataFrame) -> DataFrame:
    """conv_id and its messages in order of turn."""
    packed = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(packed.alias("m")).select("conv_id", F.transform("m", lambda x: F.struct(x.role.alias("role"), x.content.alias("content"))).alias("messages"))


def to_turns(chats: DataFrame) -> DataFrame:
    """conv_id, turn, role, text."""
    return chats.select("conv_id", F.posexplode("messages").alias("turn", "m")).select("conv_id", "turn", F.col("m.role").alias("role"), F.col("m.content").alias("text"))


def canonical_role(role: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in ROLE_NAMES.items() for x in pair))
    return F.element_at(names, F.lower(F.trim(role)))


def roles(messages: Column) -> Column:
    return F.transform(messages, lambda m: m.role)


def of_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m.role == role)


def first_of(messages: Column, role: str) -> Column:
    return F.try_element_at(of_role(messages, role), F.lit(1)).content


def last_of(messages: Column, role: str) -> Column:
    return F.try_element_at(of_role(messages, role), F.lit(-1)).content


def role_string(messages: Column) -> Column:
    return F.array_join(roles(messages), ",")


def total_chars(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0).cast("long"), lambda a, m: a + F.coalesce(F.length(m.content), F.lit(0)))


def adjacent_equal(messages: Column, among: list[str]) -> Column:
    """Whether two neighbouring messages share one of these roles."""
    r = roles(messages)
    pairs = F.arrays_zip(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))).alias("a"), F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))).alias("b"))
    return F.exists(pairs, lambda p: (p.a == p.b) & p.a.isin(among))


def full_text(messages: Column, budget: int) -> Column:
    """Messages as "[ROLE]: text" lines within a budget of characters.

    System text stands first and may use only what the other messages and a line end
    leave; text that does not fit is cut and marked.
    """
    line = lambda m: F.concat(F.lit("["), F.upper(m.role), F.lit("]: "), F.coalesce(m.content, F.lit("")))
    cut = lambda t, n: F.when(F.length(t) <= n, t).otherwise(F.concat(F.left(t, n), F.lit(" ...[truncated]")))
    rest = F.array_join(F.transform(F.filter(messages, lambda m: m.role != "system"), line), "\n")
    system = F.array_join(F.transform(of_role(messages, "system"), line), "\n")
    room = F.lit(budget) - F.length(rest) - 1
    both = F.when((system != "") & (room > 0), F.concat(cut(system, room), F.lit("\n"), rest)).otherwise(rest)
    return F.when(rest == "", cut(system, F.lit(budget))).when(F.length(rest) > budget, cut(rest, F.lit(budget))).otherwise(both)


def trim_to_last(messages: Column, role: str = "assistant") -> Column:
    """Messages up to the last one of that role; none if there is none."""
    last = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(messages), F.lit(1))), F.lit(0), lambda a, i: F.when(F.try_element_at(messages, i).role == role, i).otherwise(a))
    return F.slice(messages, 1, last)


def merge_same_role(messages: Column, joint: str = "\n\n") -> Column:
    """Neighbouring messages of one role become one."""
    first = F.slice(messages, 1, 0)
    step = lambda a, m: F.when(
        (F.size(a) > 0) & (F.try_element_at(a, F.lit(-1)).role == m.role),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(m.role.alias("role"), F.concat(F.try_element_at(a, F.lit(-1)).content, F.lit(joint), m.content).alias("content")))),
    ).otherwise(F.concat(a, F.array(m)))
    return F.aggregate(messages, first, step)
