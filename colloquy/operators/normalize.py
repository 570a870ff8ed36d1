"""Schema normalisation: which columns of a table are the chat, and text formats of chats.

``plan`` looks at column names only, once for each table; ``to_chats`` turns the plan
into expressions. Template parsers split rendered text into messages with lookahead
splits, so they stay in the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions.text import is_blank, strip

# Column names of each slot in order of preference, and words that tell of a slot.
NAMES = {
    "chat": ["messages", "conversations", "conversation", "turns", "dialogue", "exchanges"],
    "system": ["system", "system_prompt", "sys_prompt", "persona", "role_prompt"],
    "user": [
        "question", "problem", "prompt", "query", "input", "human", "user", "inputs", "user_prompt", "problem_statement", "instruction",
        "original_question", "q", "text", "context", "document", "passage", "sentence",
    ],
    "assistant": [
        "output", "answer", "response", "solution", "generated_solution", "completion", "gpt", "assistant", "model_response", "my_solu",
        "chosen", "target", "a", "spoken_english", "spoken", "positive",
    ],
    "think": ["<think>", "think", "reasoning", "chain_of_thought", "cot", "rationale", "gt_cot", "reasoning_content", "thinking", "thought"],
}
WORDS = {
    "chat": {"messages", "conversations", "conversation", "turns", "dialogue", "exchanges", "chat"},
    "system": {"system", "persona"},
    "user": {"question", "problem", "prompt", "query", "instruction"},
    "assistant": {"answer", "response", "output", "solution", "completion"},
    "think": {"think", "reasoning", "cot", "rationale", "thought", "thinking"},
}
NOT_TEXT = {
    "language", "lang", "type", "id", "ids", "count", "score", "label", "category", "class", "level", "index", "flag", "date", "year", "month",
    "day", "code", "format", "model", "version", "num", "length", "size", "hash", "key", "url", "path", "source", "name", "difficulty",
    "domain", "made_by", "multi_turn", "embedding", "embeddings", "cluster",
}
JOINED = ["context_before", "equation", "context_after"]
FREE_TEXT = {"text", "context", "document", "passage", "sentence"}
FREE_TEXT_MOST_COLUMNS = 10


@dataclass
class Plan:
    """mode: chat (column ``chat`` holds it), fields, or none."""

    mode: str = "none"
    chat: str | None = None
    system: str | None = None
    user: list[str] = field(default_factory=list)
    think: str | None = None
    assistant: str | None = None


def name_words(name: str) -> set[str]:
    """Lower-case words of a column name, plurals also without their s."""
    found = {w.lower() for w in re.findall(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+", name)}
    return found | {w[:-1] for w in found if len(w) > 3 and w.endswith("s")}


def tells(name: str, words: set[str]) -> bool:
    of = name_words(name)
    return not of & NOT_TEXT and bool(of & words)


def plan(columns: list[str]) -> Plan:
    """The slots of a table. Exact names come first, then names that tell of a slot."""
    exact = {c.lower(): c for c in columns}

    def named(slot: str) -> str | None:
        return next((exact[n] for n in NAMES[slot] if n in exact), None)

    def telling(words: set[str]) -> str | None:
        return next((c for c in columns if tells(c, words)), None)

    if chat := named("chat"):
        return Plan("chat", chat)
    assistant = named("assistant")
    if not assistant and (chat := telling(WORDS["chat"])):
        return Plan("chat", chat)
    assistant = assistant or telling(WORDS["assistant"])
    if not assistant:
        text = telling(FREE_TEXT) or telling(WORDS["user"])
        return Plan("chat", text) if text and len(columns) <= FREE_TEXT_MOST_COLUMNS else Plan()
    task, data = telling({"instruction"}), telling({"input"})
    if "instruction" in exact and "input" in exact:
        user = [exact["instruction"], exact["input"]]
    elif first := named("user"):
        user = [first]
    elif task and data and task != data:
        user = [task, data]
    elif "equation" in exact:
        user = [exact[c] for c in JOINED if c in exact]
    else:
        user = [c for c in (telling(WORDS["user"]) or telling(FREE_TEXT),) if c]
    return Plan("fields", None, named("system") or telling(WORDS["system"]), user, named("think") or telling(WORDS["think"]), assistant)


def from_fields(p: Plan) -> Column:
    """Messages of a row of a fields plan; blank ones are left out."""
    text = lambda c: strip(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))
    user = F.array_join(F.filter(F.array(*map(text, p.user)), lambda x: x != ""), "\n\n") if p.user else F.lit("")
    answer = text(p.assistant)
    if p.think:
        answer = F.when(text(p.think) != "", F.concat(F.lit("<think>"), text(p.think), F.lit("</think>\n\n"), answer)).otherwise(answer)
    made = [("system", text(p.system))] if p.system else []
    made += [("user", user), ("assistant", answer)]
    return F.filter(F.array(*(F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in made)), lambda m: m.content != "")


def usable(messages: Column) -> Column:
    return F.exists(messages, lambda m: m.role == "user") & F.exists(messages, lambda m: m.role == "assistant")


def _split_by(text: Column, before: str, head: str) -> Column:
    """Messages of text split before each mark; ``head`` captures a message's role, the rest is its content."""
    parts = F.filter(F.split(text, f"(?={before})"), lambda p: p.rlike(rf"(?s)\A{head}"))
    made = F.transform(parts, lambda p: F.struct(M.canonical_role(F.regexp_extract(p, head, 1)).alias("role"), strip(F.regexp_replace(p, rf"(?s)\A{head}", "")).alias("content")))
    return M.merge_same_role(F.filter(made, lambda m: m.role.isNotNull() & ~is_blank(m.content)))


#: Template, a mark that tells of it, where messages are split, and a pattern whose group is the role.
TEMPLATES = {
    "chatml": (r"<\|im_start\|>", r"<\|im_start\|>", r"<\|im_start\|>\s*(\w+)\s*(?:<\|im_sep\|>)?"),
    "llama3": (r"<\|start_header_id\|>", r"<\|start_header_id\|>", r"<\|start_header_id\|>\s*(\w+)\s*<\|end_header_id\|>"),
    "zephyr": (r"<\|(?:user|assistant|system|prompter)\|>", r"<\|(?:user|assistant|system|prompter)\|>", r"<\|(\w+)\|>"),
    "human_assistant": (r"### (?:Human|Assistant):", r"### (?:Human|Assistant):", r"### (\w+):"),
    "prompt_response": (r"### Prompt", r"### (?:Prompt|Response)", r"### (\w+):?"),
    "transcript": (r"(?im)^(?:User|Human|Assistant|GPT|AI|System)\s*[:：]", r"(?im)^(?:User|Human|Assistant|GPT|AI|System)\s*[:：]", r"(?i)(User|Human|Assistant|GPT|AI|System)\s*[:：]"),
}
END_MARKS = r"<\|(?:im_end|eot_id|eom_id|end_of_text|endoftext|begin_of_text)\|>|</s>"


def parse(text: Column) -> Column:
    """struct(template, messages) of the first template that yields a user and an assistant message; null if none does."""
    plain = F.regexp_replace(text, END_MARKS, "")
    aliases = F.regexp_replace(F.regexp_replace(plain, r"<\|prompter\|>", "<|user|>"), r"(?m)^### Prompt", "### Human")
    aliases = F.regexp_replace(F.regexp_replace(aliases, r"(?m)^### Response", "### Assistant"), r"(?im)^AI(\s*[:：])", "Assistant$1")
    tried = []
    for name, (mark, before, head) in TEMPLATES.items():
        head = head if name != "prompt_response" else r"### (\w+):?"
        before = before if name != "prompt_response" else r"### (?:Human|Assistant)\b(?!:)"
        found = _split_by(aliases, before, head)
        tried.append(F.when(text.rlike(mark), F.when(usable(found), F.struct(F.lit(name).alias("template"), found.alias("messages")))))
    return F.coalesce(*tried)


def template_name(text: Column) -> Column:
    """The first template whose mark occurs; null if none does."""
    return F.coalesce(*(F.when(text.rlike(mark), F.lit(name)) for name, (mark, _, _) in TEMPLATES.items()))


def to_chats(df: DataFrame, p: Plan | None = None) -> DataFrame:
    """df with messages, by a plan for its columns; rows that yield none have null."""
    p = p or plan(df.columns)
    if p.mode == "fields":
        made = from_fields(p)
        return df.withColumn("messages", F.when(usable(made), made))
    if p.mode == "chat" and dict(df.dtypes)[p.chat] == "string":
        return df.withColumn("messages", parse(F.col(f"`{p.chat}`")).messages)
    if p.mode == "chat":
        return df.withColumnRenamed(p.chat, "messages")
    return df.withColumn("messages", F.lit(None).cast("array<struct<role:string,content:string>>"))


def canonical(chats: DataFrame, source: str = "") -> DataFrame:
    """The canonical record of each chat: counts, estimates and identity hashes."""
    m = F.col("messages")
    text = F.array_join(F.transform(m, lambda x: F.coalesce(x.content, F.lit(""))), "\n")
    key = lambda c: F.md5(F.lower(strip(F.regexp_replace(c, r"(?U)[\x{200B}\x{FEFF}]|\s+", " "))))
    users = F.size(M.of_role(m, "user"))
    return chats.select(
        "*",
        F.size(m).alias("n_turns"),
        (users > 1).alias("multi_turn"),
        M.total_chars(m).alias("num_chars"),
        F.expr("0L").alias("_z"),
        key(F.coalesce(M.first_of(m, "user"), F.lit(""))).alias("prompt_hash"),
        key(text).alias("content_hash"),
        F.lit(source).alias("source"),
    ).withColumn("num_tokens_est", F.expr("num_chars div 4")).drop("_z")
