"""Report-only scans: quality flags, context probes, tool coverage and needles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions.text import alnum_count, let, ngrams, repetition_ratio, word_set, words

# Patterns of the probes.
UNFILLED = r"\{\{\s*\w+\s*\}\}|\[(?:insert|your|add)\b[^\]]*\]|<(?:insert|your)\b[^>]*>"
DEICTIC = r"(?i)\b(?:this|the above|the following|attached)\s+(?:image|picture|table|figure|code|text|passage|document)\b"
FUNCTION_WORD_END = r"(?i)\b(?:the|a|an|of|to|and|or|in|on|for|with|is|are)\s*$"
LACKS_CONTEXT = r"(?i)(?:you (?:haven't|have not|didn't|did not) (?:provide|include|attach)|no (?:text|image|file|context) (?:was|is) (?:provided|attached)|please (?:provide|share) the)"


def max_char_run(c: Column) -> Column:
    """Length of the longest run of one character."""
    runs = F.regexp_extract_all(c, F.lit(r"(?s)((.)\2*)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def loop_score(c: Column, n: int = 8, least: int = 60) -> Column:
    """How often the most frequent n-gram of words occurs; 0 below ``least`` words."""

    def over(w: Column) -> Column:
        sorted_grams = F.array_sort(ngrams(w, n))
        longest = F.aggregate(
            sorted_grams,
            F.struct(F.lit("").alias("g"), F.lit(0).alias("run"), F.lit(0).alias("best")),
            lambda a, g: F.struct(g.alias("g"), F.when(a.g == g, a.run + 1).otherwise(F.lit(1)).alias("run"), F.greatest(a.best, F.when(a.g == g, a.run + 1).otherwise(F.lit(1))).alias("best")),
            lambda a: a.best,
        )
        return F.when(F.size(w) < least, F.lit(0)).otherwise(longest)

    return let(words(c), over)


def text_flags(c: Column) -> dict[str, Column]:
    n = F.length(c)
    return {
        "tiny": n < 20,
        "low_alnum": (n > 0) & (alnum_count(c) / F.greatest(n, F.lit(1)) < 0.3),
        "repetitive": repetition_ratio(c) > 0.5,
        "punctuation_run": c.rlike(r"[!-/:-@\[-`{-~]{40,}"),
        "unfilled_template": c.rlike(UNFILLED),
    }


def chat_flags(messages: Column) -> dict[str, Column]:
    """Flags of a chat's first prompt and last answer."""
    user, answer = F.coalesce(M.first_of(messages, "user"), F.lit("")), F.coalesce(M.last_of(messages, "assistant"), F.lit(""))
    one_line = F.length(user).between(25, 140) & ~user.contains("\n")
    return {
        "dangling_colon": user.rlike(r":\s*$"),
        "deictic_prompt": user.rlike(DEICTIC) & (F.length(user) < 200),
        "cut_off_prompt": one_line & user.rlike(FUNCTION_WORD_END),
        "answer_lacks_context": answer.rlike(LACKS_CONTEXT),
        "no_word_overlap": (F.length(user) >= 60) & (F.length(answer) >= 150) & ~F.arrays_overlap(word_set(user), word_set(answer)),
        "thought_outweighs_answer": answer.contains("</think>") & (F.length(answer) > 9 * F.length(F.substring_index(answer, "</think>", -1))),
    }


def counted(df: DataFrame, flags: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """Rows and how many have each flag, in one aggregation."""
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n_rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()))


def needles(df: DataFrame, needle: str, most: int = 3) -> DataFrame:
    """column and value of the first rows of each string column that hold a needle."""
    found = None
    for n in [n for n, t in df.dtypes if t == "string"]:  # the least values of each column, kept by every task of a scan of that column alone
        part = df.select(F.lit(n).alias("column"), F.col(n).alias("value")).where(F.contains("value", F.lit(needle))).orderBy("value").limit(most)
        found = part if found is None else found.unionByName(part)
    return found
