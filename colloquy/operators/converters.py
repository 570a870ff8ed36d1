"""Source-specific conversion of tables to chats, by a registry.

A converter names the columns it reads, the ordered conditions under which a row is
skipped, and the expression that builds its messages. Scans read only those columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions.text import is_blank, strip
from .dedup import longest_per_key
from .rules import first_of

CONVERTERS: dict[str, Converter] = {}
#: Sources that are left out on purpose, with the reason.
SKIPPED: dict[str, str] = {"benchmark": "held out for evaluation"}


@dataclass
class Converter:
    columns: list[str]
    messages: Callable[[], Column]
    skips: Callable[[], dict[str, Column]] = dict
    schema: str = ""


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def pair(user: Column, answer: Column, system: Column | None = None) -> Column:
    """System (if any), user and assistant messages; blank ones are left out."""
    parts = ([message("system", strip(system))] if system is not None else []) + [message("user", strip(user)), message("assistant", strip(answer))]
    return F.filter(F.array(*parts), lambda m: m.content != "")


def text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def register(name: str, columns: list[str], skips: Callable[[], dict[str, Column]] = dict):
    def add(messages: Callable[[], Column]) -> Callable[[], Column]:
        CONVERTERS[name] = Converter(columns, messages, skips)
        return messages

    return add


@register("standard", ["messages"])
def standard():
    return F.filter(F.transform("messages", lambda m: F.struct(M.canonical_role(m.role).alias("role"), F.coalesce(m.content, F.lit("")).alias("content"))), lambda m: m.role.isNotNull())


@register("resolved_trajectories", ["messages", "resolved"], lambda: {"skip_not_resolved": ~F.coalesce("resolved", F.lit(False))})
def resolved():
    return standard()


@register("rewarded_trajectories", ["messages", "reward"], lambda: {"skip_partial_round_prefix": F.col("reward").isNull(), "skip_reward_not_1": F.col("reward") != 1.0})
def rewarded():
    return standard()


def _score() -> Column:
    return F.get_json_object("response_quality_assessment", "$.overall_score").cast("double")


@register("scored_tool_chats", ["messages", "response_quality_assessment"], lambda: {"skip_no_quality_score": _score().isNull(), "skip_quality_below_4": _score() < 4.0})
def scored():
    """messages is a JSON string here; tool lists inside system texts are dropped."""
    parsed = F.from_json("messages", "array<struct<role:string,content:string>>")
    named = F.transform(parsed, lambda m: F.struct(F.when(m.role == "tool_call", "assistant").otherwise(M.canonical_role(m.role)).alias("role"), strip(F.regexp_replace(F.coalesce(m.content, F.lit("")), r"(?s)<tools>.*?</tools>", "")).alias("content")))
    return F.filter(named, lambda m: m.role.isNotNull() & (m.content != ""))


@register("preferred", ["chosen"])
def preferred():
    return F.transform("chosen", lambda m: F.struct(M.canonical_role(m.role).alias("role"), m.content.alias("content")))


@register("instruction_input", ["instruction", "input", "output"])
def instruction_input():
    given = strip(text("input"))
    real = (given != "") & ~F.lower(given).isin("none", "n/a")
    return pair(F.when(real, F.concat(text("instruction"), F.lit("\n\nInput: "), given)).otherwise(text("instruction")), text("output"))


@register("instruction_as_system", ["instruction", "input", "output"])
def instruction_as_system():
    given = strip(text("input"))
    return pair(F.when(given != "", given).otherwise(text("instruction")), text("output"), F.when(given != "", text("instruction")).otherwise(F.lit("")))


@register("multiple_choice", ["question", "options", "rationale", "correct"])
def multiple_choice():
    asked = F.concat(text("question"), F.lit("\n\nOptions:\n"), F.array_join(F.coalesce("options", F.array().cast("array<string>")), "\n"))
    why, right = strip(text("rationale")), strip(text("correct"))
    stated = (right == "") | F.contains(F.right(why, F.lit(40)), right)
    return pair(asked, F.when(stated, why).otherwise(F.concat(why, F.lit("\n\nAnswer: "), right)))


#: Solution language codes in order of preference, and their fences.
SOLUTION_LANGUAGES = [(3, "python"), (2, "cpp"), (4, "java")]


def _solution() -> Column:
    solved = F.arrays_zip(F.col("solutions.language").alias("language"), F.col("solutions.solution").alias("solution"))
    tried = []
    for code, fence in SOLUTION_LANGUAGES:
        body = F.try_element_at(_of_language(solved, code), F.lit(1)).solution
        tried.append(F.when(body.isNotNull(), F.concat(F.lit(f"```{fence}\n"), strip(body), F.lit("\n```"))))
    return F.coalesce(*tried)


def _of_language(solved: Column, code: int) -> Column:
    return F.filter(solved, lambda s: (s.language == code) & ~is_blank(s.solution))


@register("code_solutions", ["description", "solutions"], lambda: {"skip_no_solution": _solution().isNull()})
def code_solutions():
    return pair(text("description"), _solution())


def _answers() -> Column:
    return F.filter(F.coalesce("answers", F.array().cast("array<string>")), lambda a: ~is_blank(a))


@register("plot_questions", ["plot", "question", "answers", "no_answer"], lambda: {"skip_no_answer": F.coalesce("no_answer", F.lit(False)) | (F.size(_answers()) == 0)})
def plot_questions():
    asked = F.concat(F.lit("Read the following movie plot and answer the question.\n\nPlot:\n"), strip(text("plot")), F.lit("\n\nQuestion: "), strip(text("question")))
    return pair(asked, F.try_element_at(_answers(), F.lit(1)))


INST = r"(?s)^\[INST\]\s*<<SYS>>\s*(.*?)\s*<</SYS>>\s*(.*?)\s*\[/INST\]\s*$"


@register("inst_prompt", ["prompt", "answer"], lambda: {"skip_unparsed_prompt": ~text("prompt").rlike(INST)})
def inst_prompt():
    return pair(F.regexp_extract("prompt", INST, 2), text("answer"), F.regexp_extract("prompt", INST, 1))


@register("prompt_response", ["prompt", "response"])
def prompt_response():
    return pair(text("prompt"), text("response"))


@register("question_answer", ["question", "answer"])
def question_answer():
    return pair(text("question"), text("answer"))


MARKED = r"(?m)(?=^(?:USER|ASSISTANT|FUNCTION RESPONSE):)"


@register("marked_chat", ["system", "chat"])
def marked_chat():
    """Turns that USER:, ASSISTANT: and FUNCTION RESPONSE: begin."""
    role = lambda p: F.when(p.startswith("USER:"), "user").when(p.startswith("ASSISTANT:"), "assistant").when(p.startswith("FUNCTION RESPONSE:"), "tool")
    turns = F.transform(F.filter(F.split(text("chat"), MARKED), lambda p: p.rlike(r"^(?:USER|ASSISTANT|FUNCTION RESPONSE):")), lambda p: F.struct(role(p).alias("role"), strip(F.regexp_replace(F.regexp_replace(p, r"^[A-Z ]+:\s?", ""), r"<\|endoftext\|>", "")).alias("content")))
    system = strip(F.regexp_replace(text("system"), r"^SYSTEM:", ""))
    return F.filter(F.concat(F.array(message("system", system)), turns), lambda m: m.content != "")


@register("spans", ["spans"])
def spans():
    """The span with the most input messages, and its output."""
    size = lambda s: F.size(F.from_json(s.attributes["input.messages"], "array<struct<role:string,content:string>>"))
    numbered = F.transform("spans", lambda s, i: F.struct(size(s).alias("n"), (-i).alias("i"), s.alias("s")))
    best = F.array_max(F.transform(numbered, lambda x: F.struct(x.n.alias("n"), x.i.alias("i"), x.s.attributes["input.messages"].alias("said"), x.s.attributes["output.value"].alias("answer"))))
    said = F.from_json(best.said, "array<struct<role:string,content:string>>")
    return F.filter(F.concat(said, F.array(message("assistant", F.coalesce(best.answer, F.lit(""))))), lambda m: m.content != "")


def longest_sessions(df: DataFrame, key: str = "_row") -> DataFrame:
    """Of logs that repeat a session's beginning, the longest of each session (known by its first two messages)."""
    numbered = df.withColumn(key, F.monotonically_increasing_id())
    first = F.md5(F.to_json(F.slice("messages", 1, 2)))
    return longest_per_key(numbered, first, F.size("messages"), key).drop(key)


def convert(df: DataFrame, name: str) -> DataFrame:
    """df's rows as messages and skip (why there are none)."""
    if name in SKIPPED or name not in CONVERTERS:
        why = SKIPPED.get(name, "unknown source")
        return df.select(F.lit(None).cast("array<struct<role:string,content:string>>").alias("messages"), F.lit(why).alias("skip"))
    c = CONVERTERS[name]
    made = df.select(*c.columns)
    named = c.skips()
    skip = first_of(named) if named else F.lit(None).cast("string")
    out = made.select(F.when(skip.isNull(), c.messages()).alias("messages"), skip.alias("skip"))
    ended = F.col("messages").isNull() | ~F.exists("messages", lambda m: m.role == "user") | (F.try_element_at("messages", F.lit(-1)).role != "assistant")
    out = out.withColumn("skip", F.coalesce("skip", F.when(ended, "skip_empty_or_invalid")))
    return out.withColumn("messages", F.when(F.col("skip").isNull(), F.col("messages")))


def report(df: DataFrame) -> DataFrame:
    """How many rows of a conversion were kept or skipped, and their share."""
    counted = df.groupBy(F.coalesce("skip", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counted.crossJoin(F.broadcast(total)).select("outcome", "n", F.round(100.0 * F.col("n") / F.greatest("total", F.lit(1)), 4).alias("pct"))
