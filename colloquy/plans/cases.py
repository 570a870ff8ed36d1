"""Queries over chats changed so that every rule has rows to fire on.

Both engines derive the same chats from ``conversations``: which change a chat gets
follows from its conv_id, so all chats take part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import messages as M
from ..operators import rules
from ..operators.repair import repair
from .registry import query

#: Text of the last assistant turn, by conv_id modulo 36.
_ANSWERS = {
    1: "'<think></think>' || text",
    2: "'<think>. . .</think>' || text",
    3: "'<think>' || text",
    4: "'<think>reasons here</think> '",
    5: "repeat('x', 60) || text",
    6: "repeat('no ', 30) || text",
    7: "repeat('.', 350)",
    8: "text || chr(7)",
    9: "text || '���'",
    10: "'[{' || chr(39) || 'type' || chr(39) || ': 1}]'",
    11: "text || '[truncated]'",
    12: "'None'",
    13: "text || '<|im_end|>'",
    14: "'see <|im_start|> inside ' || text",
    15: "'<answer>' || text || '</answer>'",
    16: "' '",
    17: "'<think><think>a good reason</think></think>' || text",
    18: "repeat('one two three four five six seven eight nine ten eleven ', 25)",
    19: "'Technical difficulties. Please continue with the task.'",
    20: "'Hmm, ' || text",
    21: "'<tool_call>{}' || text",
    22: "'Your question seems incomplete. ' || text",
    25: "'the very same words'",
    29: "'null'",
    32: "'<think>ok then</think>'",
    33: "'<think>The user wants me to create a problem</think>' || text",
    34: "'I will call `lookup` now. ' || text",
    35: "'<tool_call>[1]</tool_call>'",
}
#: Text of the first user turn.
_PROMPTS = {
    22: "'please explain to me what the'",
    23: "'Describe this <image> now'",
    24: "'Summarize the following text:'",
    25: "'the very same words'",
    26: "'Explain <DNA> ACGTACGTACGTACGT please'",
    30: "'Question: what is it?' || chr(10) || 'Answer: it is the long answer to the question asked'",
    34: "'You have function calling. ' || text",
}
_CASES = f"""SELECT conv_id, turn,
  CASE WHEN v = 27 AND turn = ft AND role <> 'tool' THEN 'tool' WHEN v = 28 AND turn = ft THEN 'alien' WHEN v = 31 AND turn = ft THEN 'human' ELSE role END AS role,
  CASE {' '.join(f"WHEN v = {k} AND turn = la THEN {x}" for k, x in _ANSWERS.items())} {' '.join(f"WHEN v = {k} AND turn = fu THEN {x}" for k, x in _PROMPTS.items())}
  WHEN v IN (0, 36) AND role = 'system' THEN ' ' ELSE text END AS text
FROM (SELECT conv_id, turn, role, text, mod(conv_id, 36) AS v, min(turn) OVER (PARTITION BY conv_id) AS ft, min(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS fu,
  max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS la FROM %s) x"""


def _chats(t):
    turns = t("conversations")
    return M.from_turns(turns.sparkSession.sql(_CASES.replace("{", "{{").replace("}", "}}") % "{turns}", turns=turns))


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _drop(c: str, *patterns: str) -> str:
    for p in patterns:
        c = f"regexp_replace({c}, '{p}', ' ', 'g')"
    return c


_THINK, _CODE, _TOOLS = r"(?is)<think>.*?</think>", r"(?s)```.*?```", r"(?is)<tool_response>.*?</tool_response>|<tool_call>.*?</tool_call>"
_CALLS = r'(?i)<tool_call>|<function=|<\|python_tag\|>|"function_call"|<invoke\b|Action Input:'
_WORDS = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"


def _run(c: str, n: int) -> str:
    return f"len(list_filter(list_distinct(regexp_extract_all({c}, '\\p{{L}}')), lambda z: contains({c}, repeat(z, {n})))) > 0"


#: Messages with what the rules look at; times: the three most frequent ten-word phrases of the spoken part.
_MESSAGES = rf"""c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM ({_CASES % "conversations"})),
m AS (SELECT *, {_strip("text")} AS s, {_drop("text", _THINK, _CODE, _TOOLS)} AS body, {_drop("text", _CODE)} AS plain,
  array_to_string(list_transform(regexp_extract_all(lower(text), '</?think>'), lambda z: CASE WHEN z = '<think>' THEN 'o' ELSE 'c' END), '') AS tags,
  regexp_extract_all(text, '(?is)<think>(.*?)</think>', 1) AS thoughts FROM c),
w AS (SELECT conv_id, p, which, CASE WHEN which = 'body' THEN {_WORDS.format("body")} ELSE {_WORDS.format("plain")} END AS w FROM m, (SELECT unnest(['body', 'plain']) AS which) WHERE role = 'assistant'),
g AS (SELECT conv_id, p, which, len(w) AS n, array_to_string(w[i:i + 9], ' ') AS gram, i FROM (SELECT *, unnest(range(1, len(w) - 8)) AS i FROM w)),
f AS (SELECT conv_id, p, which, n, gram, count(*) AS times, row_number() OVER (PARTITION BY conv_id, p, which ORDER BY count(*) DESC, min(i)) AS k FROM g GROUP BY conv_id, p, which, n, gram),
loops AS (SELECT conv_id, p, bool_or(which = 'body' AND n > 200 AND k <= 3 AND times >= 8 AND times * 10 >= 0.25 * n AND len(list_filter(string_split(gram, ' '), lambda z: regexp_matches(z, '^\p{{L}}{{2,}}$'))) >= 6) AS phrase,
  bool_or(which = 'plain' AND n >= 150 AND k = 1 AND times >= 12 AND len(list_filter(string_split(gram, ' '), lambda z: regexp_matches(z, '\p{{L}}'))) >= 5) AS repeated FROM f GROUP BY conv_id, p)"""

_FIRSTS = f"""chat AS (SELECT conv_id, list(role ORDER BY turn) AS r, coalesce({_strip("arg_min(text, turn) FILTER (role = 'user')")}, '') AS u, coalesce({_strip("arg_min(text, turn) FILTER (role = 'assistant')")}, '') AS a,
  coalesce(arg_max(text, turn) FILTER (role = 'assistant'), '') AS z, coalesce(arg_max(text, turn) FILTER (role = 'user'), '') AS lu, count(*) FILTER (role = 'user') AS users, sum(length(text)) AS chars,
  array_to_string(list(text ORDER BY turn) FILTER (role IN ('system', 'user')), chr(10)) AS asked FROM c GROUP BY conv_id)"""

_FILTER = rf"""WITH {_MESSAGES}, {_FIRSTS},
before AS (SELECT conv_id, p, last_value(CASE WHEN role <> 'tool' THEN role = 'assistant' AND regexp_matches(text, '{_CALLS}') END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS call FROM m),
structure AS (SELECT conv_id, 'bad_role' AS reason FROM m WHERE role NOT IN ('system', 'user', 'assistant', 'tool') UNION SELECT conv_id, 'empty_content' FROM m WHERE s = ''),
one AS (SELECT conv_id, unnest([
  CASE WHEN regexp_matches(text, '[\x00-\x08\x0b\x0c\x0e-\x1a\x1c-\x1f]') THEN 'control_char' END,
  CASE WHEN length(text) - length(replace(text, chr(65533), '')) >= 3 THEN 'replacement_chars' END,
  CASE WHEN regexp_matches(text, '^\s*\[\s*\{{\s*[''"](text|type|content|role)[''"]\s*:') THEN 'content_python_repr' END,
  CASE WHEN regexp_matches(text, '\[truncated\]\s*$') THEN 'truncated_marker' END,
  CASE WHEN role = 'tool' AND NOT coalesce(call, false) THEN 'tool_result_without_call' END,
  CASE WHEN role = 'assistant' AND lower(s) IN ('none', 'null', 'n/a', 'nan', '[]', '{{}}', 'nil', 'undefined') THEN 'placeholder_answer' END,
  CASE WHEN role = 'assistant' AND regexp_matches(tags, '^(oc)*oo') THEN 'think_nested_or_doubled' WHEN role = 'assistant' AND NOT regexp_matches(tags, '^(oc)*$') THEN 'think_unbalanced' END,
  CASE WHEN role = 'assistant' AND regexp_matches(tags, '^(oc)+$') AND len(list_filter(thoughts, lambda z: regexp_matches(z, '^\s*$'))) > 0 THEN 'think_empty' END,
  CASE WHEN role = 'assistant' AND regexp_matches(tags, '^(oc)+$') AND len(list_filter(thoughts, lambda z: NOT regexp_matches(z, '^\s*$') AND length(regexp_replace(z, '[^\p{{L}}\p{{N}}]', '', 'g')) < 5)) > 0 THEN 'think_placeholder' END,
  CASE WHEN role = 'assistant' AND regexp_matches(tags, '^(oc)+$') AND regexp_matches(regexp_replace(text, '(?is)^.*</think>', ''), '^\s*$') AND NOT regexp_matches(text, '{_CALLS}') THEN 'think_without_answer' END,
  CASE WHEN role = 'assistant' AND regexp_matches(body, '(?:\.\s){{30,}}\.|\.{{200,}}') THEN 'dots_run' END,
  CASE WHEN role = 'assistant' AND {_run("body", 40)} THEN 'char_run' END,
  CASE WHEN role = 'assistant' AND len(list_filter(list_distinct({_WORDS.format("lower(body)")}), lambda z: contains(' ' || array_to_string({_WORDS.format("lower(body)")}, ' ') || ' ', ' ' || repeat(z || ' ', 25)))) > 0 THEN 'word_loop' END,
  CASE WHEN role = 'assistant' AND coalesce(phrase, false) THEN 'phrase_loop' END]) AS reason
  FROM m JOIN before USING (conv_id, p) LEFT JOIN loops USING (conv_id, p)),
whole AS (SELECT conv_id, unnest([
  CASE WHEN list_contains(r[2:], 'system') THEN 'system_not_first' END,
  CASE WHEN coalesce(list_filter(r, lambda z: z <> 'system')[1], '') <> 'user' THEN 'first_not_user' END,
  CASE WHEN r[-1] <> 'assistant' THEN 'last_not_assistant' END,
  CASE WHEN len(list_filter(range(1, len(r)), lambda i: r[i] = r[i + 1] AND r[i] IN ('user', 'assistant'))) > 0 THEN 'consecutive_same_role' END,
  CASE WHEN u <> '' AND u = a THEN 'answer_equals_question' END,
  CASE WHEN length(u) <= 200 AND u LIKE '%:' AND regexp_matches(u, '(?i)(following|below|given|this|these|attached|provided)\b[^\n:]{{0,60}}\b(text|snippet|passage|document|article|paragraph|excerpt|abstract|content|context|extract|code|conversation|dialogue|review|sentence|question|story)s?\b[^\n:]{{0,20}}:\s*$') THEN 'prompt_missing_input' END]) AS reason FROM chat),
found AS (SELECT conv_id, reason FROM structure UNION SELECT conv_id, reason FROM (SELECT * FROM one UNION ALL SELECT * FROM whole) WHERE reason IS NOT NULL AND conv_id NOT IN (SELECT conv_id FROM structure))
SELECT conv_id, coalesce(string_agg(reason, ',' ORDER BY reason), '') AS reasons FROM chat LEFT JOIN found USING (conv_id) GROUP BY conv_id"""


@query(_FILTER)
def case_filter_reasons(t):
    return _chats(t).select("conv_id", F.array_join(rules.filter_reasons(F.col("messages")), ",").alias("reasons"))


_END = r"(\s*(<\|im_end\|>|<\|eot_id\|>|<\|eom_id\|>|<\|end_of_text\|>|<\|endoftext\|>|<\|im_sep\|>|</s>))+\s*$"
_SPECIAL = r"<\|(im_start|im_end|im_sep|endoftext|eot_id|eom_id|start_header_id|end_header_id|begin_of_text|end_of_text|python_tag|fim_[a-z]+|pad|reserved_special_token_\d+)\|>|\[/?INST\]|<</?SYS>>"
_CUT = r"(?i)(question|sentence|prompt|query|message|text|input|request|statement|title)\s+(seems|appears|looks|is|was|got|has been)\s+(to be\s+)?(incomplete|cut off|truncated|unfinished)"
_REJECT = rf"""WITH {_MESSAGES.replace("c AS (SELECT *,", "c AS (SELECT * REPLACE (CASE lower(trim(role)) WHEN 'human' THEN 'user' ELSE role END AS role),", 1)}, {_FIRSTS},
t AS (SELECT *, regexp_replace(regexp_replace(text, '(?i)<think>(\s*<think>)+', '<think>', 'g'), '(?i)</think>(\s*</think>)+', '</think>', 'g') AS once FROM m WHERE role <> 'system' OR s <> ''),
b AS (SELECT *, regexp_extract_all(once, '(?is)<think>(.*?)</think>', 1) AS bodies, len(regexp_extract_all(lower(once), '<think>')) AS opened, len(regexp_extract_all(lower(once), '</think>')) AS closed,
  regexp_extract_all(text, '(?s)<tool_call>\s*(.*?)\s*</tool_call>', 1) AS blocks FROM t),
h AS (SELECT conv_id, bool_or(p <= 2 AND role IN ('system', 'user') AND regexp_matches(left(text, 3000), '(?i)<functions>|<tools>|function[- ]calling|function signatures')) AS told FROM b GROUP BY conv_id),
x AS (SELECT b.conv_id, b.p,
  CASE WHEN role = 'assistant' AND opened <> closed THEN 'think_unbalanced'
    WHEN role = 'assistant' AND len(list_filter(bodies, lambda z: lower({_strip("z")}) IN ('', 'none', 'null', 'n/a', 'nan'))) > 0 THEN 'think_empty'
    WHEN role = 'assistant' AND len(list_filter(bodies, lambda z: length(regexp_replace(z, '[^\p{{L}}\p{{N}}]', '', 'g')) < 5)) > 0 THEN 'think_junk'
    WHEN regexp_matches(regexp_replace(text, '{_END}', ''), '{_SPECIAL}') THEN 'special_token_in_text' END AS first_pass,
  CASE WHEN role = 'tool' THEN 'tool_result_without_call'
    WHEN role = 'assistant' AND len(regexp_extract_all(text, '<tool_call>')) <> len(regexp_extract_all(text, '</tool_call>')) THEN 'tool_call_unbalanced'
    WHEN role = 'assistant' AND len(list_filter(blocks, lambda z: NOT regexp_matches(z, '^\{{.*"name"'))) > 0 THEN 'tool_call_unparseable'
    WHEN role = 'assistant' AND told AND len(blocks) = 0 AND regexp_matches(text, '(?i)\bI (need|will|should) (to )?call (the )?`?\w+') THEN 'tool_call_dropped' END AS calls,
  role = 'assistant' AND len(bodies) > 0 AND regexp_matches(regexp_replace(once, '{_THINK}', '', 'g'), '^\s*$') AS silent,
  CASE WHEN s = '' THEN 'empty_content' WHEN regexp_matches(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x{{FFFD}}]') THEN 'control_or_replacement_char'
    WHEN role = 'assistant' AND {_run("plain", 25)} THEN 'single_char_run' WHEN role = 'assistant' AND regexp_matches(plain, '(\.\s){{30,}}|\.{{300,}}') THEN 'dot_run'
    WHEN role = 'assistant' AND coalesce(repeated, false) THEN 'repetition_loop' END AS second_pass, role
  FROM b JOIN h USING (conv_id) LEFT JOIN loops USING (conv_id, p)),
y AS (SELECT conv_id, arg_min(first_pass, p) FILTER (first_pass IS NOT NULL) AS f1, arg_min(calls, p) FILTER (calls IS NOT NULL) AS f2, bool_or(silent) AS silent, arg_min(second_pass, p) FILTER (second_pass IS NOT NULL) AS f3,
  array_to_string(list(role ORDER BY p), ',') AS roles FROM x GROUP BY conv_id)
SELECT conv_id, CASE WHEN list_contains(r, 'alien') THEN 'bad_role'
  WHEN len(list_filter(range(1, len(r) + 1), lambda i: r[i] = 'user')) > 0 AND conv_id IN (SELECT conv_id FROM m WHERE role = 'user' AND regexp_matches(text, '(^|[^`\w/])<image>([^`\w]|$)')) THEN 'missing_context_placeholder'
  WHEN length(u) BETWEEN 15 AND 220 AND NOT contains(u, chr(10)) AND NOT regexp_matches(u, '[.?!:;)\]}}"`>]$') AND regexp_matches(left(a, 700), '{_CUT}') THEN 'missing_context_cutoff'
  WHEN f1 IS NOT NULL THEN f1 WHEN f2 IS NOT NULL THEN f2 WHEN silent THEN 'think_no_answer'
  WHEN NOT regexp_matches(coalesce(roles, ''), '^(system,)?(user,(assistant,(tool,)+)*assistant,)*user,(assistant,(tool,)+)*assistant$') THEN 'seq_invalid'
  WHEN f3 IS NOT NULL THEN f3
  WHEN {_strip("z")} IN ('None', 'null', 'N/A', 'nan', '[]', '{{}}', 'NULL') THEN 'placeholder_answer'
  WHEN u = {_strip("z")} AND u <> '' THEN 'answer_equals_question' WHEN chars > 3000 THEN 'too_long'
  WHEN users = 1 AND length(u) < 160 AND regexp_matches(u, '(?i)(following|below|given)\s+(text|passage|snippet|excerpt|article|paragraph|document|context|abstract|sentence|story|extract)s?(\s+snippet)?\s*:?\s*$') THEN 'prompt_missing_payload' END AS reason
FROM chat LEFT JOIN y USING (conv_id)"""


@query(_REJECT)
def case_reject_reason(t):
    return _chats(t).select("conv_id", rules.reject_reason(F.col("messages"), 3000).alias("reason"))


_AUDIT = rf"""WITH {_MESSAGES}, {_FIRSTS}, last AS (SELECT *, {_strip("CASE WHEN contains(z, '</think>') THEN string_split(z, '</think>')[-1] ELSE z END")} AS shown FROM chat),
one AS (SELECT conv_id, unnest([
  CASE WHEN role NOT IN ('system', 'user', 'assistant', 'tool') THEN 'unknown_role' END,
  CASE WHEN regexp_matches(text, '<\|(im_start|im_end|im_system|im_middle|im_user|im_assistant|endoftext|eot_id|begin_of_text|end_of_text|start_header_id|end_header_id|eom_id)\|>') THEN 'special_token_leak' END,
  CASE WHEN role = 'assistant' AND s = 'Technical difficulties. Please continue with the task.' THEN 'harness_error_text' END,
  CASE WHEN role = 'assistant' AND contains(text, '<think>') AND NOT contains(text, '</think>') THEN 'think_not_closed' END,
  CASE WHEN role = 'assistant' AND s = '' THEN 'empty_assistant' END,
  CASE WHEN role = 'assistant' AND contains(text, '</think>') AND regexp_matches(string_split(text, '</think>')[-1], '^\s*$') THEN 'answer_empty_after_think' END,
  CASE WHEN role = 'user' AND regexp_matches(text, '^Question:') AND regexp_matches(text, '\nAnswer:') THEN 'answer_in_prompt' END,
  CASE WHEN role = 'assistant' AND regexp_matches(text, '^<think>The user wants me to create a problem</think>') THEN 'think_is_problem_creation' END]) AS check_name FROM m),
whole AS (SELECT conv_id, unnest([
  CASE WHEN r[-1] <> 'assistant' THEN 'does_not_end_with_assistant' END,
  CASE WHEN r[1] = 'system' AND len(r) > 1 AND r[2] = 'assistant' THEN 'system_then_assistant' END,
  CASE WHEN list_contains(r[2:], 'system') THEN 'system_not_first' END,
  CASE WHEN list_contains(r, 'assistant') AND shown = '' THEN 'final_answer_empty' END,
  CASE WHEN regexp_matches(shown, '^(Hmm|Let me think|Okay, so I)') THEN 'selftalk_outside_think' END,
  CASE WHEN shown IN ('null', 'None', 'NaN') AND NOT contains(lower(asked), lower(shown)) THEN 'degenerate_answer' END]) AS check_name FROM last)
SELECT DISTINCT conv_id, check_name FROM (SELECT * FROM one UNION ALL SELECT * FROM whole) WHERE check_name IS NOT NULL"""


@query(_AUDIT)
def case_audit_checks(t):
    return _chats(t).select("conv_id", F.explode(rules.audit_checks(F.col("messages"))).alias("check_name"))


@query(
    rf"""WITH c AS (SELECT * FROM ({_CASES % "conversations"})), l AS (SELECT conv_id, max(turn) FILTER (role = 'assistant') AS m, max(turn) AS n FROM c GROUP BY conv_id)
SELECT DISTINCT conv_id, repair FROM (
  SELECT conv_id, 'role_renamed' AS repair FROM c WHERE role = 'human'
  UNION ALL SELECT conv_id, 'empty_system_dropped' FROM c WHERE role = 'system' AND trim(text) = ''
  UNION ALL SELECT conv_id, 'special_token_end_stripped' FROM c WHERE text LIKE '%<|im\_end|>' ESCAPE '\'
  UNION ALL SELECT conv_id, 'duplicate_think_tag_collapsed' FROM c WHERE role = 'assistant' AND contains(text, '<think><think>')
  UNION ALL SELECT conv_id, 'empty_think_stripped' FROM c WHERE role = 'assistant' AND contains(text, '<think></think>')
  UNION ALL SELECT conv_id, 'answer_tag_unwrapped' FROM c WHERE role = 'assistant' AND contains(text, '</answer>')
  UNION ALL SELECT conv_id, 'trailing_turns_trimmed' FROM l WHERE m IS NULL OR m < n)"""
)
def case_repairs(t):
    return repair(_chats(t)).select("conv_id", F.explode("repairs").alias("repair"))
