"""Queries over chats."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions.text import strip, template_key
from ..operators import dedup, rules
from ..operators.repair import repair
from .registry import query

_ALL = "SELECT conv_id, turn, role, text FROM conversations"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_USER0 = "(SELECT conv_id, arg_min(text, turn) AS u FROM conversations WHERE role = 'user' GROUP BY conv_id)"
_LAST_A = "(SELECT conv_id, arg_max(text, turn) AS a FROM conversations WHERE role = 'assistant' GROUP BY conv_id)"
_FIRST_A = "(SELECT conv_id, arg_min(text, turn) AS a FROM conversations WHERE role = 'assistant' GROUP BY conv_id)"
_ROLES = "(SELECT conv_id, list(role ORDER BY turn) AS r, list(text ORDER BY turn) AS t FROM conversations GROUP BY conv_id)"

_REASONS = rf"""
WITH c AS (SELECT r.conv_id, r.r, r.t, {_STRIP.format("coalesce(u.u, '')")} AS u, {_STRIP.format("coalesce(a.a, '')")} AS a
  FROM {_ROLES} r LEFT JOIN {_USER0} u USING (conv_id) LEFT JOIN {_FIRST_A} a USING (conv_id)),
x AS (SELECT conv_id, list_filter([
  CASE WHEN list_contains(r[2:], 'system') THEN 'system_not_first' END,
  CASE WHEN coalesce(list_filter(r, lambda z: z <> 'system')[1], '') <> 'user' THEN 'first_not_user' END,
  CASE WHEN r[-1] <> 'assistant' THEN 'last_not_assistant' END,
  CASE WHEN len(list_filter(range(1, len(r)), lambda i: r[i] = r[i + 1] AND r[i] IN ('user', 'assistant'))) > 0 THEN 'consecutive_same_role' END,
  CASE WHEN len(list_filter(t, lambda z: regexp_matches(z, '[\x00-\x08\x0b\x0c\x0e-\x1a\x1c-\x1f]'))) > 0 THEN 'control_char' END,
  CASE WHEN len(list_filter(range(1, len(r) + 1), lambda i: r[i] = 'assistant' AND lower({_STRIP.format("t[i]")}) IN ('none', 'null', 'n/a', 'nan', '[]', '{{}}', 'nil', 'undefined'))) > 0 THEN 'placeholder_answer' END,
  CASE WHEN u <> '' AND u = a THEN 'answer_equals_question' END
  ], lambda z: z IS NOT NULL) AS reasons FROM c)"""


@query(f"{_REASONS} SELECT conv_id, array_to_string(list_sort(reasons), ',') AS reasons FROM x")
def filter_reasons(t):
    chats = M.from_turns(t("conversations"))
    return chats.select("conv_id", F.array_join(rules.filter_reasons(F.col("messages")), ",").alias("reasons"))


@query(
    f"""{_REASONS}, e AS (SELECT unnest(CASE WHEN len(reasons) = 0 THEN ['(kept)'] ELSE reasons END) AS reason FROM x)
SELECT reason, count(*) AS n_rows, round(100.0 * count(*) / (SELECT count(*) FROM x), 4) AS pct_rows FROM e GROUP BY reason"""
)
def filter_report(t):
    return rules.report(M.from_turns(t("conversations")), rules.filter_reasons(F.col("messages")))


@query(
    rf"""WITH c AS (SELECT r.conv_id, array_to_string(r.r, ',') AS s, r.r, r.t, {_STRIP.format("coalesce(u.u, '')")} AS u, {_STRIP.format("coalesce(a.a, '')")} AS a
  FROM {_ROLES} r LEFT JOIN {_USER0} u USING (conv_id) LEFT JOIN {_LAST_A} a USING (conv_id))
SELECT conv_id, CASE
  WHEN NOT regexp_matches(s, '^(system,)?(user,assistant,)*user,assistant$') THEN 'seq_invalid'
  WHEN a IN ('None', 'null', 'N/A', 'nan', '[]', '{{}}', 'NULL') THEN 'placeholder_answer'
  WHEN u = a AND u <> '' THEN 'answer_equals_question'
  WHEN list_sum(list_transform(t, lambda z: length(z))) > 3000 THEN 'too_long' END AS reason FROM c"""
)
def first_reject_reason(t):
    chats = M.from_turns(t("conversations"))
    return chats.select("conv_id", rules.reject_reason(F.col("messages"), 3000).alias("reason"))


@query("SELECT role, count(*) AS n, sum(length(text)) AS chars, min(turn) AS first_turn, max(turn) AS last_turn FROM conversations GROUP BY role")
def role_counts(t):
    return t("conversations").groupBy("role").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"))


@query("SELECT shape, count(*) AS n FROM (SELECT conv_id, CASE WHEN count(*) FILTER (role = 'user') = 0 THEN 'no_user' WHEN count(*) FILTER (role = 'user') = 1 THEN 'single_turn' ELSE 'multi_turn' END || CASE WHEN count(*) FILTER (role = 'system') > 0 THEN '+system' ELSE '' END AS shape FROM conversations GROUP BY conv_id) GROUP BY shape")
def turn_shape(t):
    users, system = F.count_if(F.col("role") == "user"), F.count_if(F.col("role") == "system")
    shape = F.concat(F.when(users == 0, "no_user").when(users == 1, "single_turn").otherwise("multi_turn"), F.when(system > 0, "+system").otherwise(""))
    return t("conversations").groupBy("conv_id").agg(shape.alias("shape")).groupBy("shape").agg(F.count("*").alias("n"))


@query("SELECT users, messages, count(*) AS n FROM (SELECT least(count(*) FILTER (role = 'user'), 5) AS users, least(count(*), 10) AS messages FROM conversations GROUP BY conv_id) GROUP BY ALL")
def turn_shape_capped(t):
    capped = t("conversations").groupBy("conv_id").agg(F.least(F.count_if(F.col("role") == "user"), F.lit(5)).alias("users"), F.least(F.count("*"), F.lit(10)).alias("messages"))
    return capped.groupBy("users", "messages").agg(F.count("*").alias("n"))


@query(f"SELECT array_to_string(r, ',') AS role_sequence, count(*) AS n FROM {_ROLES} GROUP BY 1 ORDER BY n DESC, role_sequence LIMIT 10")
def role_sequence_topk(t):
    counted = M.from_turns(t("conversations")).groupBy(M.role_string(F.col("messages")).alias("role_sequence")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "role_sequence").limit(10)


_AUDIT = rf"""WITH c AS (SELECT r.conv_id, r.r, r.t, coalesce(a.a, '') AS a FROM {_ROLES} r LEFT JOIN {_LAST_A} a USING (conv_id)),
e AS (SELECT conv_id, unnest(list_filter([
  CASE WHEN r[-1] <> 'assistant' THEN 'does_not_end_with_assistant' END,
  CASE WHEN r[1] = 'system' AND len(r) > 1 AND r[2] = 'assistant' THEN 'system_then_assistant' END,
  CASE WHEN list_contains(r[2:], 'system') THEN 'system_not_first' END,
  CASE WHEN list_contains(r, 'assistant') AND trim(a) = '' THEN 'final_answer_empty' END,
  CASE WHEN regexp_matches({_STRIP.format("a")}, '^(Hmm|Let me think|Okay, so I)') THEN 'selftalk_outside_think' END
], lambda z: z IS NOT NULL)) AS check_name FROM c)"""


@query(f"{_AUDIT} SELECT conv_id, check_name FROM e")
def audit_checks(t):
    chats = M.from_turns(t("conversations"))
    return chats.select("conv_id", F.explode(rules.audit_checks(F.col("messages"))).alias("check_name"))


@query(f"{_AUDIT} SELECT check_name, count(*) FILTER (conv_id % 2 = 0) AS even, count(*) FILTER (conv_id % 2 = 1) AS odd, count(*) AS total, min(conv_id) AS first_row FROM e GROUP BY check_name")
def audit_pivot(t):
    chats = M.from_turns(t("conversations"))
    rows = chats.select("conv_id", F.explode(rules.audit_checks(F.col("messages"))).alias("check_name"), F.when(F.col("conv_id") % 2 == 0, "even").otherwise("odd").alias("part"))
    pivoted = rows.groupBy("check_name").pivot("part", ["even", "odd"]).agg(F.count("conv_id")).na.fill(0)
    return pivoted.join(rows.groupBy("check_name").agg(F.count("*").alias("total"), F.min("conv_id").alias("first_row")), "check_name")


@query(f"{_AUDIT} SELECT DISTINCT conv_id FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM e WHERE check_name <> 'selftalk_outside_think')")
def audit_gate(t):
    return rules.gate(M.from_turns(t("conversations"))).select("conv_id")


@query("SELECT c.conv_id, count(*) AS n_kept, max(turn) AS last_turn FROM conversations c JOIN (SELECT conv_id, max(turn) AS m FROM conversations WHERE role = 'assistant' GROUP BY conv_id) x ON c.conv_id = x.conv_id AND c.turn <= x.m GROUP BY c.conv_id")
def trim_to_last_assistant(t):
    w = W.partitionBy("conv_id")
    kept = t("conversations").withColumn("m", F.max(F.when(F.col("role") == "assistant", F.col("turn"))).over(w)).where("turn <= m")
    return kept.groupBy("conv_id").agg(F.count("*").alias("n_kept"), F.max("turn").alias("last_turn"))


@query(f"SELECT conv_id FROM {_ROLES} WHERE NOT (r[1] = 'system' AND coalesce(r[2], '') = 'assistant')")
def drop_system_then_assistant(t):
    return M.from_turns(t("conversations")).where(~M.role_string(F.col("messages")).rlike("^system,assistant")).select("conv_id")


@query("SELECT conv_id, turn, role FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p = role")
def consecutive_same_role(t):
    before = F.lag("role").over(W.partitionBy("conv_id").orderBy("turn"))
    return t("conversations").withColumn("p", before).where("p = role").select("conv_id", "turn", "role")


@query("SELECT conv_id, turn, md5(u) AS user_md5 FROM (SELECT *, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS u FROM conversations) WHERE role = 'assistant'")
def last_user_before_assistant(t):
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    said = F.last(F.when(F.col("role") == "user", F.col("text")), True).over(w)
    return t("conversations").withColumn("u", said).where("role = 'assistant'").select("conv_id", "turn", F.md5("u").alias("user_md5"))


@query("SELECT conv_id, sum(length(text)) AS chars FROM conversations GROUP BY conv_id HAVING sum(length(text)) > 2000")
def too_long(t):
    return M.from_turns(t("conversations")).select("conv_id", M.total_chars(F.col("messages")).alias("chars")).where("chars > 2000")


@query(
    r"""WITH x AS (SELECT conv_id, coalesce(string_agg('[' || upper(role) || ']: ' || text, chr(10) ORDER BY turn) FILTER (role <> 'system'), '') AS rest,
  coalesce(string_agg('[' || upper(role) || ']: ' || text, chr(10) ORDER BY turn) FILTER (role = 'system'), '') AS sys FROM conversations GROUP BY conv_id),
y AS (SELECT *, 3500 - length(rest) - 1 AS room FROM x)
SELECT conv_id, md5(CASE WHEN rest = '' THEN CASE WHEN length(sys) > 3500 THEN left(sys, 3500) || ' ...[truncated]' ELSE sys END
  WHEN length(rest) > 3500 THEN left(rest, 3500) || ' ...[truncated]'
  WHEN sys <> '' AND room > 0 THEN CASE WHEN length(sys) > room THEN left(sys, room) || ' ...[truncated]' ELSE sys END || chr(10) || rest ELSE rest END) AS text_md5 FROM y"""
)
def full_text_render(t):
    return M.from_turns(t("conversations")).select("conv_id", F.md5(M.full_text(F.col("messages"), 3500)).alias("text_md5"))


_KEY = r"md5(lower(regexp_replace(regexp_replace({0}, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')))"


@query(f"SELECT min(conv_id) AS conv_id FROM (SELECT conv_id, {_KEY.format('string_agg(text, chr(10) ORDER BY turn)')} AS k FROM conversations GROUP BY conv_id) GROUP BY k")
def content_hash_dedup(t):
    chats = M.from_turns(t("conversations"))
    text = F.array_join(F.transform("messages", lambda m: m.content), "\n")
    return dedup.first_wins(chats, dedup.text_key(text), "conv_id").select("conv_id")


@query(
    r"""WITH u AS (SELECT conv_id, arg_min(text, turn) AS u FROM conversations WHERE role = 'user' GROUP BY conv_id),
k AS (SELECT conv_id, lower(u) AS k FROM u)
SELECT conv_id, k FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY conv_id) AS r FROM k) WHERE r <= 2"""
)
def prompt_cap(t):
    chats = M.from_turns(t("conversations")).select("conv_id", F.lower(M.first_of(F.col("messages"), "user")).alias("k")).where("k is not null")
    return dedup.cap_by_key(chats, ["k"], ["conv_id"], 2)


@query("WITH x AS (SELECT conv_id, left(arg_min(text, turn), 3) AS k, count(*) AS n FROM conversations GROUP BY conv_id) SELECT conv_id, n FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, conv_id) AS r FROM x) WHERE r = 1")
def longest_per_prefix(t):
    chats = M.from_turns(t("conversations")).withColumn("n", F.size("messages").cast("long"))
    return dedup.longest_per_key(chats, F.left(F.try_element_at("messages", F.lit(1)).content, F.lit(3)), F.col("n"), "conv_id").select("conv_id", "n")


@query(
    rf"""WITH x AS (SELECT u.conv_id, {_KEY.format("left(u.u, 4)")} AS prompt_key, left(coalesce(a.a, ''), 60) AS head FROM {_USER0} u LEFT JOIN {_FIRST_A} a USING (conv_id))
SELECT prompt_key, count(*) AS n, count(DISTINCT head) AS n_answers FROM x GROUP BY prompt_key HAVING count(*) >= 3 AND count(DISTINCT head) >= 3"""
)
def repeated_prompt_suspects(t):
    m = F.col("messages")
    chats = M.from_turns(t("conversations")).where(M.first_of(m, "user").isNotNull())
    return dedup.repeated_prompts(chats, F.left(M.first_of(m, "user"), F.lit(4)), M.first_of(m, "assistant"), 3, 3)


@query(
    """WITH g AS (SELECT *, sum(CASE WHEN role = p THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g
  FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations))
SELECT conv_id, CAST(g - 1 AS BIGINT) AS pos, role, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_md5 FROM g GROUP BY conv_id, g, role"""
)
def merge_same_role(t):
    chats = M.from_turns(t("conversations")).withColumn("messages", M.merge_same_role(F.col("messages")))
    return M.to_turns(chats).select("conv_id", F.col("turn").cast("long").alias("pos"), "role", F.md5("text").alias("text_md5"))


@query(
    r"""SELECT conv_id, 'trailing_turns_trimmed' AS repair FROM (SELECT conv_id, arg_max(role, turn) AS r FROM conversations GROUP BY conv_id) WHERE r <> 'assistant'"""
)
def repairs_applied(t):
    fixed = repair(M.from_turns(t("conversations")))
    return fixed.select("conv_id", F.explode("repairs").alias("repair"))


@query(r"""SELECT k AS template_key, count(*) AS n FROM (SELECT array_to_string(list_filter(regexp_split_to_array(regexp_replace(left(u, 70), '[\d$\\]+', '#', 'g'), '\s+'), lambda w: w <> '')[1:4], ' ') AS k FROM """ + _USER0 + ") GROUP BY k")
def prompt_template_keys(t):
    users = M.from_turns(t("conversations")).select(M.first_of(F.col("messages"), "user").alias("u")).where("u is not null")
    return users.groupBy(template_key(F.col("u")).alias("template_key")).agg(F.count("*").alias("n"))


@query(rf"SELECT conv_id, length({_STRIP.format('arg_min(text, turn)')}) AS n FROM conversations WHERE role = 'user' GROUP BY conv_id HAVING length({_STRIP.format('arg_min(text, turn)')}) < 160")
def short_prompts(t):
    chats = M.from_turns(t("conversations")).select("conv_id", F.length(strip(M.first_of(F.col("messages"), "user"))).alias("n"))
    return chats.where("n < 160")


@query(
    """WITH x AS (SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS running FROM conversations)
SELECT conv_id, count(*) AS n_fit FROM x WHERE running <= 1000 GROUP BY conv_id"""
)
def running_budget(t):
    w = W.partitionBy("conv_id").orderBy("turn")
    return t("conversations").withColumn("running", F.sum(F.length("text")).over(w)).where("running <= 1000").groupBy("conv_id").agg(F.count("*").alias("n_fit"))


@query(
    """WITH c AS (SELECT conv_id, sum(length(text)) AS num_chars, count(*) AS n_turns, count(*) FILTER (role = 'user') > 1 AS multi_turn FROM conversations GROUP BY conv_id)
SELECT conv_id, n_turns, multi_turn, num_chars, num_chars // 4 AS num_tokens_est FROM c"""
)
def canonical_record(t):
    from ..operators.normalize import canonical

    made = canonical(M.from_turns(t("conversations")))
    return made.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "multi_turn", "num_chars", "num_tokens_est")


@query("SELECT conv_id, min(turn) FILTER (r <= 1 OR b <= 1) AS a, count(*) FILTER (r <= 1 OR b <= 1) AS n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS b FROM conversations) GROUP BY conv_id")
def head_and_tail(t):
    from ..operators.sampling import ends

    return ends(t("conversations"), "conv_id", "turn", 1).groupBy("conv_id").agg(F.min("turn").alias("a"), F.count("*").alias("n"))


@query()
def chat_templates(t):
    """Conversations rendered in one template and parsed back: conv_id, template, n_messages."""
    from ..operators.normalize import parse

    turns = t("conversations")
    rendered = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    packed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", rendered.alias("s")))).alias("a"))
    text = packed.select("conv_id", F.array_join(F.transform("a", lambda x: x.s), "").alias("text"))
    return text.withColumn("p", parse(F.col("text"))).where("p is not null").select("conv_id", F.col("p.template").alias("template"), F.size("p.messages").alias("n_messages"))
