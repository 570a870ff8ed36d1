"""Row rules over chats: drop-only filter, ordered rejection, audit and its gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions.text import after_think, alnum_count, alpha_count, char_run, is_blank, let, strip, top_grams, word_loop, words
from .dedup import looped

# Patterns and lists whose matches decide the results.
THINK_BLOCK = r"(?is)<think>(.*?)</think>"
CODE_BLOCK = r"(?s)```.*?```"
TOOL_BLOCK = r"(?is)<tool_response>.*?</tool_response>|<tool_call>.*?</tool_call>"
CALL_MARK = r'(?i)<tool_call>|<function=|<\|python_tag\|>|"function_call"|<invoke\b|Action Input:'
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1a\x1c-\x1f]"
CONTROL_OR_REPLACEMENT = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFD}]"
DOTS = r"(?:\.\s){30,}\.|\.{200,}"
DOT_RUN = r"(?:\.\s){30,}|\.{300,}|\x{2026}{100,}"
PYTHON_REPR = r"^\s*\[\s*\{\s*['\"](?:text|type|content|role)['\"]\s*:"
PLACEHOLDERS = ["none", "null", "n/a", "nan", "[]", "{}", "nil", "undefined"]
PLACEHOLDERS_EXACT = ["None", "null", "N/A", "nan", "[]", "{}", "NULL"]
MISSING_INPUT = (
    r"(?i)(?:following|below|given|this|these|attached|provided)\b[^\n:]{0,60}\b(?:text|snippet|passage|document|article|paragraph|excerpt"
    r"|abstract|content|context|extract|code|conversation|dialogue|review|sentence|question|story)s?\b[^\n:]{0,20}:\s*$"
)
MISSING_PAYLOAD = r"(?i)(?:following|below|given)\s+(?:text|passage|snippet|excerpt|article|paragraph|document|context|abstract|sentence|story|extract)s?(?:\s+snippet)?\s*:?\s*$"
SPECIAL_TOKENS = (
    r"<\|(?:im_start|im_end|im_sep|endoftext|eot_id|eom_id|start_header_id|end_header_id|begin_of_text|end_of_text|python_tag|fim_[a-z]+|pad"
    r"|reserved_special_token_\d+)\|>|\[/?INST\]|<</?SYS>>"
)
AUDIT_TOKENS = r"<\|(im_start|im_end|im_system|im_middle|im_user|im_assistant|endoftext|eot_id|begin_of_text|end_of_text|start_header_id|end_header_id|eom_id)\|>"
HARNESS_TEXT = "Technical difficulties. Please continue with the task."
OUTPUT_LIMIT = "exceeded the maximum output length"
SELF_TALK = r"^(I need to (solve|figure|determine|find)|I have (this|a) (problem|question)|Okay, so I|Okay, let me|Okay, I need|Hmm|So I've got this|Alright, so I|Let me think)"
INFO_CHECKS = ["null_in_args", "answer_in_prompt", "selftalk_outside_think"]
MAX_CHARS = 200_000
# End tokens of chat templates.
END_TOKENS = r"(?:\s*(?:<\|im_end\|>|<\|eot_id\|>|<\|eom_id\|>|<\|end_of_text\|>|<\|endoftext\|>|<\|im_sep\|>|</s>))+\s*\z"
# What tells that a prompt's content is missing.
CONTEXT_TAG = r"(?i)(?<![`\w/])<(image|DNA|RNA|protein|smiles|mol)>(?![`\w])"
FOLLOWED_BY_SEQUENCE = (
    r"(?i)(?<![`\w/])<(?:DNA|RNA|protein)>(?![`\w])(?-i)\s*(?:[ACGTUNacgtun]{12,}|(?:[A-Z] ){10,}|[A-Z]{12,})"
    r"|(?i)(?<![`\w/])<(?:smiles|mol)>(?![`\w])(?-i)\s*(?=\S*[=()\[\]#@\d])\S{12,}"
)
SENTENCE_END = r"[.?!:;)\]}\"'\x{201D}\x{2019}`>\x{2026}\x{3002}\x{FF1F}\x{FF01}]\z"
CUT_OFF = (
    r"(?i)(question|sentence|prompt|query|message|text|input|request|statement|title)\s+(seems|appears|looks|is|was|got|has been)\s+(to be\s+|like it('s| is| was)\s+)?"
    r"(incomplete|cut off|cut-off|truncated|cut short|unfinished|abruptly)|(seems|appears|looks)\s+(to be\s+)?(incomplete|cut off|cut-off|truncated|unfinished)"
    r"|(incomplete|truncated|cut[- ]off)\s+(question|sentence|prompt|query|message|text|input)|ends abruptly|trails off|cut off mid"
)
NO_THOUGHT = ["none", "null", "n/a", "nan"]
FUNCTION_PROMPT = r"(?i)<functions>|<tools>|function[- ]calling|function signatures|access to the following (?:apis|functions|tools)"
CALL_MENTION = r"(?i)\bI (?:need|will|should|have|am going|'ll) (?:to )?call (?:the )?[`'\"]?\w+|\bBy calling (?:this|the)\b|\bcall the [`'\"]?[\w\.]+[`'\"]? function\b"
CREATION = (
    r"(?i)\A<think>\s*The user wants (me to (create|generate|write|design)|an? (new|original|completely original)|a completely original)[^.]{0,200}?\b(problem|question)"
)
ASKS_TO_CREATE = r"(?is)\b(create|generate|write|design|compose|make up|come up with)\b.{0,80}\b(problem|question|exercise|puzzle)"
QUESTION_LINE = r"(?m)^[ \t]*(?:Question|Problem)[ \t]*[:\x{FF1A}]"
ANSWER_LINE = r"(?m)^[ \t]*Answer[ \t]*[:\x{FF1A}]"
STOP_WORDS = (
    "the a an of to in and or is are was were be for on with as by at from that this it its what how why when which who do does did can could would should you we they he she my your our their"
    " not yes than then so if but about into over under between during versus"
).split()


def gathered(named: dict[str, Column]) -> Column:
    """Sorted names of the conditions that hold."""
    return F.array_sort(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in named.items()))))


def first_of(named: dict[str, Column]) -> Column:
    """Name of the first condition that holds, in the order given."""
    return F.coalesce(*(F.when(c, F.lit(n)) for n, c in named.items()))


def think_faults(c: Column) -> Column:
    """Names of the faults of the think tags of one assistant text."""
    tags = F.regexp_extract_all(F.lower(c), F.lit("</?think>"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("fault"))

    def step(a: Column, tag: Column) -> Column:
        depth = a.depth + F.when(tag == "<think>", 1).otherwise(-1)
        fault = F.when(depth > 1, "think_nested_or_doubled").when(depth < 0, "think_unbalanced").otherwise("")
        return F.struct(F.when(a.fault == "", depth).otherwise(a.depth).alias("depth"), F.when(a.fault == "", fault).otherwise(a.fault).alias("fault"))

    def over(x: Column) -> Column:
        sound = x.has & (x.seen == "")
        return gathered(
            {
                "think_nested_or_doubled": x.has & (x.seen == "think_nested_or_doubled"),
                "think_unbalanced": x.has & (x.seen == "think_unbalanced"),
                "think_empty": sound & F.exists(x.bodies, is_blank),
                "think_placeholder": sound & F.exists(x.bodies, lambda b: ~is_blank(b) & (alnum_count(b) < 5)),
                "think_without_answer": sound & is_blank(F.regexp_replace(c, r"(?is)\A.*</think>", "")) & ~c.rlike(CALL_MARK),
            }
        )

    seen = F.aggregate(tags, start, step, lambda a: F.when(a.fault != "", a.fault).when(a.depth != 0, F.lit("think_unbalanced")).otherwise(F.lit("")))
    bodies = F.regexp_extract_all(c, F.lit(THINK_BLOCK), F.lit(1))
    found = let(F.struct((F.size(tags) > 0).alias("has"), seen.alias("seen"), bodies.alias("bodies")), over)
    return F.when(c.rlike("(?i)</?think>"), found).otherwise(F.array().cast("array<string>"))


def phrase_loop(c: Column) -> Column:
    """Whether one of a text's three most frequent ten-word phrases, six words of it letters, fills a quarter of it."""

    def over(w: Column) -> Column:
        lettered = lambda g: F.size(F.filter(g.gram, lambda x: x.rlike(r"\A\p{L}{2,}\z"))) >= 6
        return (F.size(w) > 200) & F.exists(top_grams(w, 10, 3), lambda g: lettered(g) & (g.times >= 8) & (g.times * 10 >= 0.25 * F.size(w)))

    return let(words(c), over)


def repetition_loop(c: Column) -> Column:
    """Whether a text repeats one phrase or, in scripts without spaces, one window of 30 characters."""
    spaces = F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    dense = (F.length(c) >= 400) & (spaces < F.length(c) / 15)
    windows = top_grams(F.split(c, ""), 30, 1, step=3)
    in_windows = F.exists(windows, lambda g: (g.times >= 8) & (alpha_count(F.array_join(g.gram, "")) >= 20))
    return F.when(F.size(words(c)) >= 150, looped(c).isNotNull()).otherwise(F.when(dense, in_windows).otherwise(F.lit(False)))


def spoken(c: Column) -> Column:
    """A text without code, thoughts and tool blocks."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, THINK_BLOCK, " "), CODE_BLOCK, " "), TOOL_BLOCK, " ")


def loop_faults(body: Column) -> dict[str, Column]:
    """Conditions on runs and loops of the spoken part of one assistant text."""
    return {"dots_run": body.rlike(DOTS), "char_run": char_run(body, 40), "word_loop": word_loop(body, 25), "phrase_loop": phrase_loop(body)}


def reply_without_call(messages: Column) -> Column:
    """Whether a tool message stands where the turn before the tool messages is no assistant's call."""
    start = F.struct(F.lit(False).alias("call"), F.lit(False).alias("bad"))

    def step(a: Column, m: Column) -> Column:
        tool = F.coalesce(m.role == "tool", F.lit(False))
        call = F.coalesce((m.role == "assistant") & m.content.rlike(CALL_MARK), F.lit(False))
        return F.struct(F.when(tool, a.call).otherwise(call).alias("call"), (a.bad | (tool & ~a.call)).alias("bad"))

    return F.aggregate(messages, start, step, lambda a: a.bad)


def _any(messages: Column, role: str | None, test) -> Column:
    return F.exists(messages, lambda m: ((m.role == role) if role else F.lit(True)) & test(F.coalesce(m.content, F.lit(""))))


def filter_reasons(messages: Column) -> Column:
    """All drop-only reasons of a chat, sorted; none: keep it.

    Faults of structure hide all others.
    """
    structure = gathered(
        {
            "bad_role": F.exists(messages, lambda m: m.role.isNull() | ~m.role.isin(M.ROLES)),
            "content_not_string": F.exists(messages, lambda m: m.content.isNull()),
            "empty_content": F.exists(messages, lambda m: m.content.isNotNull() & is_blank(m.content)),
        }
    )
    r = M.roles(messages)
    body = F.filter(r, lambda x: x != "system")
    user, answer = strip(F.coalesce(M.first_of(messages, "user"), F.lit(""))), strip(F.coalesce(M.first_of(messages, "assistant"), F.lit("")))
    rest = {
        "system_not_first": F.array_contains(F.slice(r, 2, F.size(r)), "system"),
        "first_not_user": F.coalesce(F.try_element_at(body, F.lit(1)) != "user", F.lit(True)),
        "last_not_assistant": F.try_element_at(r, F.lit(-1)) != "assistant",
        "consecutive_same_role": M.adjacent_equal(messages, ["user", "assistant"]),
        "control_char": _any(messages, None, lambda c: c.rlike(CONTROL)),
        "replacement_chars": _any(messages, None, lambda c: F.regexp_count(c, F.lit("�")) >= 3),
        "content_python_repr": _any(messages, None, lambda c: c.rlike(PYTHON_REPR)),
        "truncated_marker": _any(messages, None, lambda c: F.regexp_replace(c, r"(?U)\s+$", "").endswith("[truncated]")),
        "placeholder_answer": _any(messages, "assistant", lambda c: F.lower(strip(c)).isin(PLACEHOLDERS)),
        "prompt_missing_input": (F.length(user) <= 200) & user.endswith(":") & user.rlike(MISSING_INPUT),
        "answer_equals_question": (user != "") & (user == answer),
        "tool_result_without_call": reply_without_call(messages),
    }
    said = F.transform(M.of_role(messages, "assistant"), lambda m: F.coalesce(m.content, F.lit("")))
    each = F.flatten(F.transform(said, lambda c: F.concat(think_faults(c), let(spoken(c), lambda body: gathered(loop_faults(body))))))
    every = F.array_sort(F.array_distinct(F.concat(gathered(rest), each)))
    return F.when(F.size(messages) == 0, F.array(F.lit("no_messages"))).otherwise(let(structure, lambda faults: F.when(F.size(faults) > 0, faults).otherwise(every)))


def collapsed_think(c: Column) -> Column:
    """The text with doubled think tags made single, and an answer repeated inside nested thoughts taken out."""
    nested = r"(?is)\A\s*<think>\s*<think>(.*?)</think>(.*?)</think>(.*)\z"
    first, second, third = (F.regexp_extract(c, nested, g) for g in (1, 2, 3))
    once = F.when(c.rlike(nested) & (strip(third) != "") & (strip(second) == strip(third)), F.concat(F.lit("<think>"), first, F.lit("</think>"), third)).otherwise(c)
    return F.regexp_replace(F.regexp_replace(once, r"(?i)(<think>)(?:\s*<think>)+", "$1"), r"(?i)(</think>)(?:\s*</think>)+", "$1")


def think_reject(c: Column) -> Column:
    """First fault of the thoughts of one assistant text, null if there is none."""

    def over(t: Column) -> Column:
        bodies = F.regexp_extract_all(t, F.lit(THINK_BLOCK), F.lit(1))
        faults = F.transform(bodies, lambda b: F.when(is_blank(b) | F.lower(strip(b)).isin(NO_THOUGHT), "think_empty").when(alnum_count(b) < 5, "think_junk"))
        tags = lambda tag: F.size(F.regexp_extract_all(F.lower(t), F.lit(tag), F.lit(0)))
        return F.when(tags("<think>") != tags("</think>"), "think_unbalanced").otherwise(F.get(F.filter(faults, lambda f: f.isNotNull()), F.lit(0)))

    return F.when(c.rlike("(?i)</?think"), let(collapsed_think(c), over))


def missing_context(messages: Column) -> Column:
    """missing_context_placeholder, missing_context_cutoff or null.

    A bare tag that stands for content, unless the content follows it; or a first
    prompt that stops in the middle of a line while the answer says that it is cut.
    """
    tags = lambda c: F.size(F.regexp_extract_all(c, F.lit(CONTEXT_TAG), F.lit(0)))
    filled = lambda c: F.size(F.regexp_extract_all(c, F.lit(FOLLOWED_BY_SEQUENCE), F.lit(0)))
    bare = F.exists(messages, lambda m: (m.role == "user") & (tags(m.content) > filled(m.content)))
    user, answer = strip(M.first_of(messages, "user")), M.first_of(messages, "assistant")
    cut = F.length(user).between(15, 220) & ~user.contains("\n") & ~user.rlike(SENTENCE_END) & F.left(answer, F.lit(700)).rlike(CUT_OFF)
    return F.when(F.coalesce(bare, F.lit(False)), "missing_context_placeholder").when(cut, "missing_context_cutoff")


def call_reject(messages: Column) -> Column:
    """First fault of the <tool_call> blocks and tool messages, null if there is none."""
    head = F.slice(messages, 1, 2)
    told = F.exists(head, lambda m: m.role.isin("system", "user") & F.left(m.content, F.lit(3000)).rlike(FUNCTION_PROMPT))
    start = F.struct(F.lit(0).alias("calls"), F.lit(0).alias("replies"), F.lit(None).cast("string").alias("reason"))

    def unanswered(a: Column) -> Column:
        return F.when((a.calls > 0) & (a.replies == 0), "tool_response_missing").when((a.calls > 0) & (a.replies != a.calls), "tool_mismatch")

    def step(a: Column, m: Column) -> Column:
        c = F.coalesce(m.content, F.lit(""))
        blocks = F.regexp_extract_all(c, F.lit(r"(?s)<tool_call>\s*(.*?)\s*</tool_call>"), F.lit(1))
        count = lambda tag: F.regexp_count(c, F.lit(tag))
        assistant = F.coalesce(m.role == "assistant", F.lit(False))
        reply = F.coalesce(m.role == "tool", F.lit(False))
        fault = (
            F.when(reply & (a.calls == 0), "tool_result_without_call")
            .when(assistant & (count("<tool_call>") != count("</tool_call>")), "tool_call_unbalanced")
            .when(assistant & F.exists(blocks, lambda b: F.get_json_object(b, "$.name").isNull()), "tool_call_unparseable")
            .when(assistant & (F.size(blocks) == 0) & told & c.rlike(CALL_MENTION), "tool_call_dropped")
        )
        calls = F.when(reply, a.calls).when(assistant, F.size(blocks)).otherwise(0)
        replies = F.when(reply, a.replies + F.greatest(count(r"(?s)<tool_response>.*?</tool_response>"), F.lit(1))).otherwise(0)
        return F.struct(calls.alias("calls"), replies.alias("replies"), F.coalesce(a.reason, F.when(~reply, unanswered(a)), fault).alias("reason"))

    # calls that end the chat need no reply
    return F.aggregate(messages, start, step, lambda a: F.coalesce(a.reason, F.when(a.replies > 0, unanswered(a))))


def lexical_mismatch(messages: Column) -> Column:
    """Whether a single long question and its answer share no content word."""
    user, answer = M.first_of(messages, "user"), F.regexp_replace(M.first_of(messages, "assistant"), THINK_BLOCK, " ")
    one = (F.size(M.of_role(messages, "user")) == 1) & (F.size(M.of_role(messages, "assistant")) == 1) & (F.size(M.of_role(messages, "tool")) == 0)
    lettered = lambda c: alpha_count(c) / F.length(c) > 0.8
    content = lambda c: F.array_except(F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}{4,}"), F.lit(0)), F.array(*map(F.lit, STOP_WORDS)))
    apart = let(F.struct(content(user).alias("u"), content(answer).alias("a")), lambda x: (F.size(x.u) >= 6) & (F.size(x.a) >= 20) & ~F.arrays_overlap(x.u, x.a))
    return one & ~answer.contains("```") & (F.length(user) >= 60) & (F.length(answer) >= 150) & lettered(user) & lettered(answer) & apart


def reject_reason(messages: Column, max_chars: int = MAX_CHARS, lexical: bool = False) -> Column:
    """First reason, in the filter's order, to reject a chat; null: keep it.

    Faults of one message's text are found message by message, as the filter reads
    them. lexical: also reject answers that share no word with their question.
    """

    def first_fault(m: Column, fault) -> Column:
        return F.get(F.filter(F.transform(m, fault), lambda r: r.isNotNull()), F.lit(0))

    def repaired(m: Column) -> Column:
        return F.when(F.coalesce(m.role == "assistant", F.lit(False)), think_reject(F.coalesce(m.content, F.lit("")))).otherwise(F.lit(None).cast("string"))

    def over(named: Column) -> Column:
        kept = F.filter(named, lambda m: F.coalesce(m.role != "system", F.lit(True)) | ~is_blank(m.content))
        user, answer = strip(F.coalesce(M.first_of(kept, "user"), F.lit(""))), strip(F.coalesce(M.last_of(kept, "assistant"), F.lit("")))
        outside = lambda c: F.regexp_replace(c, CODE_BLOCK, " ")
        without_end = lambda c: F.regexp_replace(c, END_TOKENS, "")
        sequence = M.role_string(kept).rlike(r"^(system,)?(user,(assistant,(tool,)+)*assistant,)*user,(assistant,(tool,)+)*assistant$")
        before = lambda m: F.coalesce(repaired(m), F.when(without_end(F.coalesce(m.content, F.lit(""))).rlike(SPECIAL_TOKENS), "special_token_in_text"))

        def garbage(m: Column) -> Column:
            c = F.coalesce(m.content, F.lit(""))
            said = F.coalesce(m.role == "assistant", F.lit(False))
            return (
                F.when(~F.call_function("is_valid_utf8", c), "invalid_unicode")
                .when(is_blank(c), "empty_content")
                .when(c.rlike(CONTROL_OR_REPLACEMENT), "control_or_replacement_char")
                .when(said & char_run(outside(c), 25), "single_char_run")
                .when(said & outside(c).rlike(DOT_RUN), "dot_run")
                .when(said & repetition_loop(outside(c)), "repetition_loop")
            )

        silent = _any(kept, "assistant", lambda c: c.rlike(THINK_BLOCK) & is_blank(F.regexp_replace(collapsed_think(c), THINK_BLOCK, "")))
        whole = first_of(
            {
                "think_no_answer": silent,
                "seq_invalid": ~sequence,
            }
        )
        last = first_of(
            {
                "placeholder_answer": answer.isin(PLACEHOLDERS_EXACT),
                "answer_equals_question": (user == answer) & (user != ""),
                "too_long": M.total_chars(kept) > max_chars,
                "prompt_missing_payload": (F.size(M.of_role(kept, "user")) == 1) & (F.length(user) < 160) & user.rlike(MISSING_PAYLOAD),
                **({"qa_no_word_overlap": lexical_mismatch(kept)} if lexical else {}),
            }
        )
        return F.coalesce(missing_context(named), first_fault(kept, before), call_reject(kept), whole, first_fault(kept, garbage), last)

    named = F.transform(messages, lambda m: F.struct(M.canonical_role(m.role).alias("role"), m.content.alias("content")))
    found = first_of({"no_messages": F.size(messages) <= 0, "bad_role": F.exists(messages, lambda m: M.canonical_role(m.role).isNull())})
    return F.coalesce(found, let(named, over))


def answer_in_prompt(c: Column) -> Column:
    """Whether a prompt has one question line and, after it, one answer line with text behind it."""
    parts = F.split(c, ANSWER_LINE, -1)
    one = (F.regexp_count(c, F.lit(QUESTION_LINE)) == 1) & (F.size(parts) == 2)
    return one & F.get(parts, F.lit(0)).rlike(QUESTION_LINE) & (F.length(strip(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))) >= 20)


def audit_checks(messages: Column) -> Column:
    """Names of all audit checks that a chat of plain messages violates."""
    r = M.roles(messages)
    final = F.coalesce(M.last_of(messages, "assistant"), F.lit(""))
    prompt = F.array_join(F.transform(F.filter(messages, lambda m: m.role.isin("system", "user")), lambda m: F.lower(F.coalesce(m.content, F.lit("")))), "\n")
    shown = strip(after_think(final))
    asked = F.coalesce(M.last_of(F.filter(messages, lambda m: m.role == "user"), "user"), F.lit(""))
    creates = _any(messages, "assistant", lambda c: F.left(c, F.lit(600)).rlike(CREATION) & c.contains("</think>")) & ~F.left(asked, F.lit(800)).rlike(ASKS_TO_CREATE)
    return gathered(
        {
            "empty_messages": F.size(messages) == 0,
            "unknown_role": F.exists(messages, lambda m: m.role.isNull() | ~m.role.isin(M.ROLES)),
            "content_not_string": F.exists(messages, lambda m: m.content.isNull()),
            "does_not_end_with_assistant": F.try_element_at(r, F.lit(-1)) != "assistant",
            "system_then_assistant": M.role_string(messages).rlike("^system,assistant"),
            "system_not_first": F.array_contains(F.slice(r, 2, F.size(r)), "system"),
            "special_token_leak": _any(messages, None, lambda c: c.rlike(AUDIT_TOKENS)),
            "output_limit_loop": F.size(F.filter(messages, lambda m: m.content.contains(OUTPUT_LIMIT))) >= 3,
            "harness_error_text": _any(messages, "assistant", lambda c: strip(c) == HARNESS_TEXT),
            "think_not_closed": _any(messages, "assistant", lambda c: c.contains("<think>") & ~c.contains("</think>")),
            "empty_assistant": _any(messages, "assistant", is_blank),
            "answer_empty_after_think": _any(messages, "assistant", lambda c: c.contains("</think>") & is_blank(after_think(c))),
            "final_answer_empty": F.exists(messages, lambda m: m.role == "assistant") & is_blank(after_think(final)),
            "selftalk_outside_think": shown.rlike(SELF_TALK),
            "answer_in_prompt": _any(messages, "user", answer_in_prompt),
            "think_is_problem_creation": creates,
            "degenerate_answer": shown.isin("null", "None", "NaN") & ~F.contains(prompt, F.lower(shown)),
        }
    )


def gate(chats: DataFrame) -> DataFrame:
    """Chats that violate no check but those for information."""
    return chats.where(F.size(F.array_except(audit_checks(F.col("messages")), F.array(*map(F.lit, INFO_CHECKS)))) == 0)


def report(chats: DataFrame, reasons: Column) -> DataFrame:
    """reason, rows and their share of all rows: one pass, totals by a window over the few reasons."""
    named = let(reasons, lambda r: F.when(F.size(r) == 0, F.array(F.lit("(kept)"))).otherwise(r))
    tagged = chats.select(F.explode(named).alias("reason"), "conv_id")
    counted = tagged.groupBy("reason").agg(F.count("*").alias("n_rows"))
    total = chats.agg(F.count("*").alias("total"))
    return counted.crossJoin(F.broadcast(total)).select("reason", "n_rows", F.round(100.0 * F.col("n_rows") / F.greatest("total", F.lit(1)), 4).alias("pct_rows"))
