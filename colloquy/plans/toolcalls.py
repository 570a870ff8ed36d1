"""Queries over chats with tool calls, which both engines derive from ``conversations``.

Which calls and replies a chat gets follows from its conv_id, so all chats take part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import messages as M
from ..operators import rules, toolcalls
from .registry import query

_LOOKUP = """'<tool_call>{"name": "lookup", "arguments": {"q": "' || conv_id || '"}}</tool_call>'"""
_FIND = """'<tool_call>{"name": "find", "arguments": {"q": null}}</tool_call>'"""
#: What the last assistant turn ends with, by conv_id modulo 8, and the turns put after it.
_ASKED = {1: _LOOKUP, 2: f"{_LOOKUP} || {_FIND}", 3: _LOOKUP, 4: _LOOKUP, 5: "'<tool_call>print(1)</tool_call>'", 6: f"{_LOOKUP} || {_FIND}", 7: _LOOKUP}
_AFTER = [
    (1, 1, "tool", "'<tool_response>found</tool_response>'"), (1, 2, "assistant", "'done'"),
    (2, 1, "tool", "'<tool_response>one</tool_response> <tool_response>two</tool_response>'"), (2, 2, "assistant", "'done'"),
    (3, 2, "user", "'and?'"), (3, 3, "assistant", "'done'"),
    (4, 1, "tool", "' one '"), (4, 2, "tool", "'two'"), (4, 3, "assistant", "'done'"),
    (5, 1, "tool", "'1'"), (5, 2, "assistant", "'done'"),
    (6, 1, "tool", "'one'"), (6, 2, "assistant", "'done'"),
]
_SCHEMAS = {1: """'<tools>[{"type": "function", "function": {"name": "lookup"}}]</tools>'""", 2: """'<tools>{"name": "lookup"}' || chr(10) || '{"name": "find"}</tools>'"""}
_LAST = "SELECT conv_id, mod(conv_id, 8) AS v, max(CASE WHEN role = 'assistant' THEN turn END) AS la FROM %s GROUP BY conv_id"
#: Turns after the last assistant's are left out, so that its call is the chat's last turn but for those put after it.
_CASES = f"""SELECT t.conv_id, t.turn * 10 AS turn, t.role, CASE {' '.join(f"WHEN v = {k} AND t.turn = la THEN t.text || {x.replace('conv_id', 't.conv_id')}" for k, x in _ASKED.items())} ELSE t.text END AS text
FROM %s t JOIN ({_LAST}) l ON t.conv_id = l.conv_id WHERE t.turn <= la
{' '.join(f"UNION ALL SELECT conv_id, la * 10 + {p}, '{role}', {text} FROM ({_LAST}) l WHERE v = {k} AND la IS NOT NULL" for k, p, role, text in _AFTER)}
{' '.join(f"UNION ALL SELECT conv_id, -10, 'system', {text} FROM ({_LAST}) l WHERE v = {k} AND la IS NOT NULL" for k, text in _SCHEMAS.items())}"""
_IN_SQL = _CASES.replace("%s", "conversations")


def _chats(t):
    turns = t("conversations")
    sql = _CASES.replace("{", "{{").replace("}", "}}").replace("%s", "{turns}")
    chats = M.from_turns(turns.sparkSession.sql(sql, turns=turns))
    return chats.withColumn("called", toolcalls.structured(toolcalls.full(F.col("messages")), "python")).withColumn("tools", toolcalls.extract_tools(F.col("messages")))


#: Calls and replies in order, each chat having one turn that calls.
_PARTS = rf"""WITH c AS ({_IN_SQL}),
b AS (SELECT conv_id, turn, unnest(regexp_extract_all(text, '(?s)<tool_call>\s*(.*?)\s*</tool_call>', 1)) AS block, unnest(range(1, len(regexp_extract_all(text, '(?s)<tool_call>\s*(.*?)\s*</tool_call>', 1)) + 1)) AS k FROM c WHERE role = 'assistant'),
r0 AS (SELECT conv_id, turn, unnest(CASE WHEN contains(text, '<tool_response>') THEN regexp_extract_all(text, '(?s)<tool_response>\s*(.*?)\s*</tool_response>', 1) ELSE [trim(text)] END) AS reply,
  unnest(range(1, CASE WHEN contains(text, '<tool_response>') THEN len(regexp_extract_all(text, '<tool_response>')) ELSE 1 END + 1)) AS i FROM c WHERE role = 'tool'),
r AS (SELECT conv_id, reply, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS k FROM r0),
n AS (SELECT conv_id, (SELECT count(*) FROM b WHERE b.conv_id = d.conv_id) AS calls, (SELECT count(*) FROM r WHERE r.conv_id = d.conv_id) AS replies, mod(conv_id, 8) AS v FROM (SELECT DISTINCT conv_id FROM c) d)"""


@query(
    rf"""{_PARTS} SELECT b.conv_id, 'call_' || b.k AS call_id, CASE WHEN block LIKE '{{%' THEN json_extract_string(block, '$.name') ELSE 'python' END AS tool,
  CASE WHEN block LIKE '{{%' THEN json_extract_string(block, '$.arguments.q') ELSE block END AS asked, r.reply FROM b LEFT JOIN r ON r.conv_id = b.conv_id AND r.k = b.k"""
)
def tool_calls_structured(t):
    """Calls written in texts as structured calls, with the replies linked to them."""
    calls = F.flatten(F.filter(F.transform("called", lambda m: m.tool_calls), lambda c: c.isNotNull()))
    replied = _chats(t).select("conv_id", "called", F.explode(calls).alias("c"))
    reply = F.get(F.filter("called", lambda m: (m.role == "tool") & (m.tool_call_id == F.col("c.id"))), F.lit(0)).content
    arguments = F.col("c.function.arguments")
    return replied.select("conv_id", F.col("c.id").alias("call_id"), F.col("c.function.name").alias("tool"), F.coalesce(F.get_json_object(arguments, "$.q"), F.get_json_object(arguments, "$.code")).alias("asked"), reply.alias("reply"))


@query(f"{_PARTS} SELECT conv_id, calls AS most_open, least(calls - replies, 0) AS least_open FROM n")
def tool_calls_pending(t):
    """The most calls that wait for a reply at once, and below 0 the replies without a call."""
    seen = toolcalls.pending_calls(F.col("called"))
    return _chats(t).select("conv_id", F.array_max(seen).cast("long").alias("most_open"), F.least(F.array_min(seen), F.lit(0)).cast("long").alias("least_open"))


@query(
    f"""{_PARTS} SELECT conv_id, 'null_in_args' AS check_name FROM b WHERE contains(block, ': null') UNION ALL SELECT conv_id, unnest(['tool_without_call', 'tool_without_id']) FROM n WHERE replies > calls
UNION ALL SELECT conv_id, 'tool_def_bad_shape' FROM n WHERE v = 2"""
)
def tool_call_audit(t):
    return _chats(t).select("conv_id", F.explode(toolcalls.call_checks(F.col("called"), F.col("tools"))).alias("check_name"))


@query(f"{_PARTS} SELECT conv_id, CASE v WHEN 1 THEN 'lookup' WHEN 2 THEN 'lookup,find' WHEN 5 THEN 'python' END AS tools FROM n WHERE v IN (1, 2, 5)")
def tool_schemas(t):
    """Names of the tools a chat declares, or of the python tool that its calls need."""
    chats = _chats(t).withColumn("tools", toolcalls.with_python_tool(F.col("called"), F.col("tools"))).where("tools IS NOT NULL")
    return chats.select("conv_id", F.array_join(F.transform("tools", lambda d: F.get_json_object(toolcalls.normalized_tool(d), "$.function.name")), ",").alias("tools"))


@query(
    rf"""{_PARTS}, s AS (SELECT c.conv_id, string_agg(left(role, 1) || CASE WHEN role = 'assistant' THEN repeat('c', len(regexp_extract_all(text, '<tool_call>'))) WHEN role = 'tool' AND contains(text, '</tool_response>') THEN repeat('t', len(regexp_extract_all(text, '<tool_response>')) - 1) ELSE '' END, '' ORDER BY turn) AS w FROM c GROUP BY c.conv_id)
SELECT conv_id, CASE WHEN NOT regexp_matches(w, '^s?(u(act|acctt)*a)*u(act|acctt)*ac*$') THEN 'seq_invalid' END AS fault FROM s"""
)
def tool_sequence_fault(t):
    return _chats(t).select("conv_id", toolcalls.sequence_fault(F.col("called")).alias("fault"))


@query(
    f"""{_PARTS} SELECT conv_id, CASE WHEN v = 5 THEN 'tool_call_unparseable' WHEN v = 3 THEN 'tool_response_missing' WHEN calls > 0 AND replies > 0 AND calls <> replies THEN 'tool_mismatch' END AS reason FROM n"""
)
def tool_call_reject(t):
    return _chats(t).select("conv_id", rules.call_reject(F.col("messages")).alias("reason"))


@query(
    r"""SELECT conv_id, turn, CASE WHEN mod(conv_id, 2) = 0 THEN '<think>' || chr(10) || 'Okay, first.' || chr(10) || chr(10) || 'Hmm.' || chr(10) || '</think>' || chr(10) || chr(10) || 'The answer is ' || conv_id || '.'
  ELSE 'Okay, first.' || chr(10) || chr(10) || 'I think the answer is ' || conv_id || '.' END AS text FROM conversations WHERE role = 'assistant'"""
)
def think_wrapped(t):
    """Replies that think aloud, as thought and answer where an answer follows the last thought."""
    said = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Okay, first.\n\nHmm.\n \nThe answer is "), "conv_id", F.lit("."))).otherwise(F.concat(F.lit("Okay, first.\n\nI think the answer is "), "conv_id", F.lit(".")))
    return t("conversations").where("role = 'assistant'").select("conv_id", "turn", toolcalls.wrap_think(said).alias("text"))


@query(r"""SELECT conv_id, turn, regexp_replace(text, '[\x00-\x1f''"\\]', ' ', 'g') || chr(10) || 'and more' AS text FROM conversations WHERE regexp_matches(text, '\S')""")
def parts_joined(t):
    """Texts written as lists of content parts in Python notation, as plain texts."""
    clean = F.regexp_replace("text", r"[\x00-\x1f'\"\\]", " ")
    listed = F.concat(F.lit("[{'type': 'text', 'text': '"), clean, F.lit("'}, {'type': 'text', 'text': None}, {'type': 'text', 'text': 'and more'}]"))
    return t("conversations").where(F.col("text").rlike(r"\S")).select("conv_id", "turn", toolcalls.joined_parts(listed).alias("text"))
