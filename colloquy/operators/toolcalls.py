"""Structured tool calls in chats: reading them from text, linking, repairing and checking them.

Messages here are of the full type (``messages.MESSAGE``): role, content, name,
tool_calls, tool_call_id. Everything is a Column expression over one chat, so that
no operator moves rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions.text import is_blank, let, strip
from .rules import gathered

CALLS = "array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"
BLOCK = r"(?s)<tool_call>\s*(.*?)\s*</tool_call>"
RESPONSE = r"(?s)<tool_response>\s*(.*?)\s*</tool_response>"
TOOLS = r"(?s)<tools>(.*?)</tools>"
LOOSE = {"allowSingleQuotes": "true", "allowUnquotedControlChars": "true"}
NUMBERED = r"\Acall_\d+\z"
# The schema of the tool whose only argument is code.
PYTHON_TOOL = (
    '{"type": "function", "function": {"name": "python", "description": "Run Python code and return what it prints (stdout and stderr).", '
    '"parameters": {"type": "object", "properties": {"code": {"type": "string", "description": "The Python code to run."}}, "required": ["code"]}}}'
)
# Signs of thinking aloud and of a final answer.
TALK_START = (
    r"(?i)\A(Okay|OK,|Alright|Hmm|I need to|I have to|I'm (trying|given|looking)|Let me|Let's see|"
    r"First, (I|the question|let)|We are (asked|given)|The (user|question|problem) (is|asks|wants))"
)
FINAL = r"(\\boxed\{|[Tt]he (final )?answer (option )?is\b)"
SELF_TALK = (
    r"(\bI (think|thought|need|recall|remember|should|will|would|guess|believe|know|can|could|have|had|must|was|am|see|"
    r"don't|do|might|want|also|just|missed|considered|go)\b"
    r"|\bI'(m|ll|ve|d)\b|\b(Hmm|Wait|Okay|Alright|Oh|Ah)\b|\b[Ll]et me\b|\b[Ll]et's\b|\b[Mm]aybe\b|\b[Pp]erhaps\b"
    r"|answer should be|\bI\.?$)"
)
PARTS_START = r"\A\s*\[\s*\{\s*['\"]"
MAX_PARTS = 600_000


def message(role: Column, content: Column, name: Column | None = None, calls: Column | None = None, reply_to: Column | None = None) -> Column:
    none = F.lit(None)
    fields = {"role": role, "content": content, "name": none if name is None else name, "tool_calls": none if calls is None else calls, "tool_call_id": none if reply_to is None else reply_to}
    return F.struct(*(c.alias(n) for n, c in fields.items())).cast(M.MESSAGE)


def full(messages: Column) -> Column:
    """Messages of role and content only, as the full type."""
    return F.transform(messages, lambda m: message(m.role, m.content))


def _changed(m: Column, **fields: Column) -> Column:
    now = {n: fields.get(n, m[n]) for n in ("role", "content", "name", "tool_calls", "tool_call_id")}
    return F.struct(*(c.alias(n) for n, c in now.items())).cast(M.MESSAGE)


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _last(a: Column) -> Column:
    return F.try_element_at(a, F.lit(-1))


def _has_calls(m: Column) -> Column:
    return F.coalesce(F.size(m.tool_calls) > 0, F.lit(False))


def valid_json(c: Column) -> Column:
    """Whether a text starts with a JSON value and, if that is an object or a list, ends with its bracket."""
    closed = strip(c).rlike(r"(?s)\A(\{.*\}|\[.*\]|[^{\[].*)\z")
    return F.coalesce(closed & F.try_parse_json(c).isNotNull(), F.lit(False))


def jsonic(c: Column) -> Column:
    """Text in Python notation with its bare constants written as in JSON."""
    for literal, value in (("None", "null"), ("True", "true"), ("False", "false")):
        c = F.regexp_replace(c, rf"(?<=[:\[,])(\s*){literal}(?=\s*[,}}\]])", f"$1{value}")
    return c


def call_of(block: Column, place: Column, code_tool: str | None = None) -> Column:
    """One call from the text of a block: JSON, Python notation, or (code_tool) raw code; null if it is none."""
    text = F.regexp_replace(block, r"\A(?:\\n|\s)+|(?:\\n|\s)+\z", "")
    kind = "struct<name:string,arguments:string,parameters:string>"

    def made(name: Column, arguments: Column) -> Column:
        return F.struct(F.concat(F.lit("call_"), place.cast("string")).alias("id"), F.lit("function").alias("type"), F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"))

    def over(t: Column) -> Column:
        call = F.from_json(F.when(valid_json(t), t).otherwise(jsonic(t)), kind, LOOSE)
        arguments = F.coalesce(call["arguments"], call["parameters"], F.lit("{}"))
        code = F.when(~t.rlike(r"\A[{\[]") & (t != ""), made(F.lit(code_tool), F.to_json(F.struct(t.alias("code"))))) if code_tool else F.lit(None)
        return F.when(call["name"].isNotNull() & t.startswith("{"), made(call["name"], arguments)).otherwise(code)

    return let(text, over)


def structured(messages: Column, code_tool: str | None = None) -> Column:
    """Chats whose calls and replies are written in tags, as structured calls with linked replies.

    Ids count up through the chat; the i-th reply after an assistant turn answers its
    i-th call. Blocks that hold no call are left out: reject such chats first.
    """
    start = F.struct(_none(M.MESSAGE).alias("out"), _none("string").alias("open"), F.lit(0).alias("n"))

    def step(a: Column, m: Column) -> Column:
        blocks = F.when((m.role == "assistant") & ~_has_calls(m), F.regexp_extract_all(m.content, F.lit(BLOCK), F.lit(1)))
        calls = F.filter(F.transform(blocks, lambda b, i: call_of(b, a.n + i + 1, code_tool)), lambda c: c.isNotNull())
        written = F.coalesce(F.size(calls) > 0, F.lit(False))
        replies = F.when(m.content.rlike(RESPONSE), F.regexp_extract_all(m.content, F.lit(RESPONSE), F.lit(1))).otherwise(F.array(strip(m.content)))
        answered = F.transform(replies, lambda r, i: message(F.lit("tool"), r, m["name"], None, F.coalesce(F.get(a.open, i), m.tool_call_id)))
        spoken = message(m.role, strip(F.regexp_replace(m.content, BLOCK, "")), m["name"], calls)
        tool = F.coalesce(m.role == "tool", F.lit(False))
        out = F.when(written, F.array(spoken)).when(tool & (F.size(a.open) > 0) & m.content.isNotNull(), answered).otherwise(F.array(_changed(m)))
        rest = F.when(tool, F.slice(a.open, F.coalesce(F.size(replies), F.lit(0)) + 1, F.greatest(F.size(a.open), F.lit(1))))
        opened = F.when(written, F.transform(calls, lambda c: c.id)).otherwise(F.coalesce(rest, _none("string")))
        return F.struct(F.concat(a.out, out).alias("out"), opened.alias("open"), (a.n + F.when(written, F.size(calls)).otherwise(0)).alias("n"))

    return F.aggregate(messages, start, step, lambda a: a.out)


def link_ids(messages: Column) -> Column:
    """Calls with unique ids, and replies that point to them in order.

    Ids that are missing, repeated in a turn or merely numbered are numbered anew; a
    reply keeps an id and a name of its own.
    """
    start = F.struct(_none(M.MESSAGE).alias("out"), _none("struct<id:string,name:string>").alias("open"), F.lit(0).alias("n"))

    def step(a: Column, m: Column) -> Column:
        ids = F.transform(m.tool_calls, lambda c: c.id)

        def numbered(c: Column, i: Column) -> Column:
            anew = c.id.isNull() | (c.id == "") | c.id.rlike(NUMBERED) | F.coalesce(F.array_contains(F.slice(ids, 1, i), c.id), F.lit(False))
            return F.struct(F.when(anew, F.concat(F.lit("call_"), (a.n + i).cast("string"))).otherwise(c.id).alias("id"), c.type.alias("type"), c.function.alias("function"))

        calls = F.transform(m.tool_calls, numbered)
        asks = (m.role == "assistant") & _has_calls(m)
        answers = (m.role == "tool") & (F.size(a.open) > 0)
        first = F.get(a.open, F.lit(0))
        own = m.tool_call_id.isNotNull() & ~m.tool_call_id.rlike(NUMBERED) & (m.tool_call_id != "")
        linked = _changed(m, tool_call_id=F.when(own, m.tool_call_id).otherwise(first.id), name=F.coalesce(m["name"], first["name"]))
        out = F.when(asks, _changed(m, tool_calls=calls)).when(answers, linked).otherwise(_changed(m))
        opened = (
            F.when(asks, F.transform(calls, lambda c: F.struct(c.id.alias("id"), c.function["name"].alias("name"))))
            .when(answers, F.slice(a.open, 2, F.greatest(F.size(a.open), F.lit(1))))
            .when(m.role.isin("user", "system"), _none("struct<id:string,name:string>"))
            .otherwise(a.open)
        )
        return F.struct(F.array_append(a.out, out).alias("out"), opened.alias("open"), (a.n + F.when(asks, F.size(m.tool_calls)).otherwise(0)).alias("n"))

    return F.aggregate(messages, start, step, lambda a: a.out)


def merge_split_calls(messages: Column) -> Column:
    """An assistant turn and the textless calls that follow it, as one turn."""

    def step(a: Column, m: Column) -> Column:
        before = _last(a)
        joins = (m.role == "assistant") & _has_calls(m) & is_blank(F.coalesce(m.content, F.lit(""))) & F.coalesce(before.role == "assistant", F.lit(False))
        joint = _changed(before, tool_calls=F.concat(F.coalesce(before.tool_calls, _none(CALLS[6:-1])), m.tool_calls))
        return F.when(joins, F.array_append(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), joint)).otherwise(F.array_append(a, _changed(m)))

    return F.aggregate(messages, _none(M.MESSAGE), step)


def with_reasoning(content: Column, reasoning: Column) -> Column:
    """An assistant text with its separate reasoning before it, as a thought; blank reasoning changes nothing."""
    thought = F.concat(F.lit("<think>\n"), strip(reasoning), F.lit("\n</think>\n\n"), strip(F.coalesce(content, F.lit(""))))
    return F.when(is_blank(F.coalesce(reasoning, F.lit(""))), content).otherwise(thought)


def wrap_think(c: Column) -> Column:
    """A reply that thinks aloud, with all before its final answer as a thought; other replies stay."""

    def over(x: Column) -> Column:
        last = lambda test: F.array_max(F.transform(x.p, lambda p, i: F.when(test(p), i)))

        def cut(y: Column) -> Column:
            join = lambda parts: strip(F.array_join(parts, "\n\n"))
            think, answer = join(F.slice(x.p, 1, y.talk + 1)), join(F.slice(x.p, y.talk + 2, F.size(x.p)))
            return F.when(y.talk < y.final, F.concat(F.lit("<think>\n"), think, F.lit("\n</think>\n\n"), answer)).otherwise(c)

        final = last(lambda p: p.rlike(FINAL))
        talk = F.array_max(F.transform(x.p, lambda p, i: F.when(p.rlike(SELF_TALK) & (i <= final), i)))
        return F.when(F.size(x.p) > 0, let(F.struct(talk.alias("talk"), final.alias("final")), cut)).otherwise(c)

    paragraphs = F.filter(F.split(strip(c), r"\n\s*\n"), lambda p: ~is_blank(p))
    aloud = strip(c).rlike(TALK_START) & ~strip(c).startswith("<think>")
    return F.when(aloud, let(F.struct(paragraphs.alias("p")), over)).otherwise(c)


def normalized_arguments(a: Column) -> Column:
    """Arguments as the text of one JSON object: nothing is {}, what is no object goes under "value"."""
    loose = jsonic(a)
    as_map = F.from_json(loose, "map<string,string>", LOOSE)
    pythonic = F.when(strip(a).startswith("{") & as_map.isNotNull() & ~is_blank(F.to_json(as_map)), F.to_json(as_map))
    plain = F.when(valid_json(a) & strip(a).startswith("{"), strip(a))
    return F.when(is_blank(F.coalesce(a, F.lit(""))), F.lit("{}")).otherwise(F.coalesce(plain, pythonic, F.to_json(F.struct(a.alias("value")))))


def map_arguments(messages: Column, change) -> Column:
    """Messages with every call's arguments changed by a function of a Column, such as a redaction."""
    call = lambda c: F.struct(c.id.alias("id"), c.type.alias("type"), F.struct(c.function["name"].alias("name"), change(c.function.arguments).alias("arguments")).alias("function"))
    return F.transform(messages, lambda m: _changed(m, tool_calls=F.transform(m.tool_calls, call)))


def extract_tools(messages: Column) -> Column:
    """JSON objects of the first <tools> block of a system turn that holds some: a list, one object, or one a line; null if there is none."""

    def parsed(block: Column) -> Column:
        lines = F.filter(F.transform(F.split(block, "\n"), strip), lambda x: x != "")
        listed = F.when(block.startswith("[") & valid_json(block), F.from_json(block, "array<string>"))
        objects = F.forall(lines, lambda x: x.startswith("{") & valid_json(x))
        found = F.coalesce(listed, F.when(objects, lines), F.when(valid_json(block), F.array(block)))
        return F.when((F.size(found) > 0) & F.forall(found, lambda x: strip(x).startswith("{")), found)

    blocks = F.flatten(F.transform(M.of_role(messages, "system"), lambda m: F.regexp_extract_all(F.coalesce(m.content, F.lit("")), F.lit(TOOLS), F.lit(1))))
    return F.get(F.filter(F.transform(blocks, lambda b: parsed(strip(b))), lambda f: f.isNotNull()), F.lit(0))


def with_python_tool(messages: Column, tools: Column) -> Column:
    """The tools of a chat; without any, the python schema where every call is python with code alone."""
    calls = F.flatten(F.filter(F.transform(messages, lambda m: m.tool_calls), lambda c: c.isNotNull()))
    only_code = lambda c: F.coalesce((c.function["name"] == "python") & (F.json_object_keys(c.function.arguments) == F.array(F.lit("code"))), F.lit(False))
    return F.when(F.coalesce(F.size(tools), F.lit(0)) > 0, tools).when((F.size(calls) > 0) & F.forall(calls, only_code), F.array(F.lit(PYTHON_TOOL)))


def normalized_tool(tool: Column) -> Column:
    """One tool definition as {"type": "function", "function": {name, description, parameters}}; null without a name."""
    flat = F.coalesce(F.get_json_object(tool, "$.function"), tool)
    name, about = F.get_json_object(flat, "$.name"), F.get_json_object(flat, "$.description")
    given = F.coalesce(F.get_json_object(flat, "$.parameters"), F.get_json_object(flat, "$.input_schema"))
    parameters = F.when(given.startswith("{") & valid_json(given), given).otherwise(F.lit('{"type":"object","properties":{}}'))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)\A\{\"v\":(.*)\}\z", 1)
    described = F.when(F.coalesce(about, F.lit("")) != "", F.concat(F.lit(',"description":'), quoted(about))).otherwise(F.lit(""))
    return F.when(F.coalesce(name, F.lit("")) != "", F.concat(F.lit('{"type":"function","function":{"name":'), quoted(name), described, F.lit(',"parameters":'), parameters, F.lit("}}")))


def pending_calls(messages: Column) -> Column:
    """After each message, how many calls of the last assistant turn still wait for a reply; below 0: replies too many."""
    start = F.struct(F.lit(0).alias("open"), _none("int").alias("seen"))

    def step(a: Column, m: Column) -> Column:
        now = F.when(m.role == "assistant", F.greatest(F.coalesce(F.size(m.tool_calls), F.lit(0)), F.lit(0))).when(m.role == "tool", a.open - 1).otherwise(F.lit(0))
        return F.struct(now.alias("open"), F.array_append(a.seen, now).alias("seen"))

    return F.aggregate(messages, start, step, lambda a: a.seen)


def sequence_fault(messages: Column) -> Column:
    """seq_invalid, empty_content or null, by turns that may follow each other and calls all answered."""
    start = F.struct(F.lit("start").alias("want"), F.lit(0).alias("open"))

    def step(a: Column, m: Column) -> Column:
        calls = F.greatest(F.coalesce(F.size(m.tool_calls), F.lit(0)), F.lit(0))
        want = (
            F.when((a.want == "start") & (m.role == "system"), "user")
            .when(a.want.isin("start", "user") & (m.role == "user"), "assistant")
            .when((a.want == "assistant") & (m.role == "assistant"), F.when(calls > 0, "tool").otherwise("user"))
            .when((a.want == "tool") & (m.role == "tool"), F.when(a.open > 1, "tool").otherwise("assistant"))
            .otherwise("never")
        )
        return F.struct(want.alias("want"), F.when(m.role == "assistant", calls).otherwise(a.open - 1).alias("open"))

    end = F.aggregate(messages, start, step, lambda a: a.want)
    final = _last(messages)
    broken = (end == "never") | ~F.coalesce(final.role == "assistant", F.lit(False))
    return F.when(broken, "seq_invalid").when(~_has_calls(final) & is_blank(F.coalesce(final.content, F.lit(""))), "empty_content")


def call_checks(messages: Column, tools: Column | None = None) -> Column:
    """Names of the audit checks on calls, replies and tool definitions (JSON texts) that a chat violates."""
    calls = F.flatten(F.filter(F.transform(messages, lambda m: m.tool_calls), lambda c: c.isNotNull()))
    arguments = F.transform(calls, lambda c: c.function.arguments)
    nulls = lambda a: F.coalesce(F.exists(F.map_values(F.from_json(a, "map<string,string>")), lambda v: v.isNull()), F.lit(False))
    shaped = lambda t: F.coalesce((F.get_json_object(t, "$.type") == "function") & F.get_json_object(t, "$.function.name").isNotNull(), F.lit(False))
    left = F.arrays_zip(M.roles(messages).alias("role"), pending_calls(messages).alias("open"))
    return gathered(
        {
            "args_not_json_string": F.exists(arguments, lambda a: a.isNull()),
            "args_invalid_json": F.exists(arguments, lambda a: a.isNotNull() & ~valid_json(a)),
            "null_in_args": F.exists(arguments, lambda a: valid_json(a) & a.startswith("{") & nulls(a)),
            "tool_without_call": F.exists(left, lambda x: (x.role == "tool") & (x.open < 0)),
            "tool_without_id": F.exists(messages, lambda m: (m.role == "tool") & (F.coalesce(m.tool_call_id, F.lit("")) == "")),
            "tool_def_bad_shape": F.exists(tools, lambda t: ~shaped(t)) if tools is not None else F.lit(False),
        }
    )


def parts(c: Column) -> Column:
    """The objects of a text that is a list of them in JSON or Python notation; null for other texts."""
    kind = "array<struct<type:string,text:string,content:string,role:string,value:string>>"
    read = lambda t: F.from_json(t, kind, {**LOOSE, "mode": "PERMISSIVE"})
    found = read(F.when(valid_json(c), c).otherwise(jsonic(c)))
    named = lambda x: x.type.isNotNull() | x.text.isNotNull() | x.role.isNotNull()
    whole = F.length(c).between(8, MAX_PARTS) & strip(c).endswith("]") & c.rlike(PARTS_START)
    return F.when(whole & (F.size(found) > 0) & F.forall(found, named), found)


def joined_parts(c: Column) -> Column:
    """A text that is a list of content parts, as its parts' texts by line; null if a part is no text; other texts stay."""
    media = lambda p: F.exists(p, lambda x: F.lower(x.type).rlike("image|audio|video"))
    texts = lambda p: F.filter(F.transform(p, lambda x: F.coalesce(x.text, x.content)), lambda t: t.isNotNull() & ~is_blank(t))
    chat = lambda p: F.forall(p, lambda x: x.role.isNotNull())
    return let(F.struct(parts(c).alias("p")), lambda x: F.when(x.p.isNull() | chat(x.p), c).when(~F.coalesce(media(x.p), F.lit(False)), F.array_join(texts(x.p), "\n")))


def unwrapped(messages: Column) -> Column:
    """A chat whose last assistant text is a dump of a whole chat, as that chat after its own system turns.

    messages: role and content. A dump with a role or text that cannot be read leaves
    the chat as it is.
    """

    def over(x: Column) -> Column:
        inner = F.transform(x.p, lambda m: F.struct(M.canonical_role(m.role).alias("role"), F.coalesce(m.content, m.value).alias("content")))
        sound = (x.last.role == "assistant") & F.forall(inner, lambda m: m.role.isNotNull() & m.content.isNotNull())
        lead = F.transform(M.of_role(F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0))), "system"), lambda m: F.struct(m.role.alias("role"), m.content.alias("content")))
        return F.when(F.coalesce(sound, F.lit(False)), F.concat(lead, inner)).otherwise(messages)

    last = _last(messages)
    return let(F.struct(last.alias("last"), parts(last.content).alias("p")), over)
