"""Labels by rule: languages in buckets, keyword categories, name rules, closed lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import alpha_count, let

# Ordered keyword rules of the fallback categories.
KEYWORDS = [
    ("Algorithm Implementation", ["def ", "function", "class ", "algorithm", "quicksort", "dijkstra", "binary search"]),
    ("Code Debugging", ["bug", "error", "traceback", "exception", "fix", "debug"]),
    ("Mathematical Computation", ["calculate", "solve", "equation", "derivative", "integral", "matrix"]),
    ("Document Summarization", ["summarize", "summary", "tldr", "bullet", "recap"]),
    ("Natural Language Translation", ["translate", "translation", "spanish", "french", "german"]),
    ("Culinary Instruction", ["recipe", "cook", "ingredients", "bake", "cuisine"]),
    ("Creative Composition", ["story", "poem", "essay", "dialogue", "creative"]),
]
NO_KEYWORD = "Conceptual Explanation"
BANNED_VALUES = ["", "NONE", "NULL", "N/A", "NA", "UNKNOWN", "OTHER", "NAN"]


def language_bucket(text: Column, lang: Column, confidence: Column, least: float = 0.5, letters: float = 0.3) -> Column:
    """The language, or why there is none: unknown, no_natural_language, uncertain."""
    n = F.length(text)
    return (
        F.when(text.isNull() | (n == 0), "unknown")
        .when(alpha_count(text) / F.greatest(n, F.lit(1)) < letters, "no_natural_language")
        .when(lang.isNull(), "unknown")
        .when(confidence < least, "uncertain")
        .otherwise(lang)
    )


def keyword_category(text: Column) -> Column:
    """The first category with a keyword in the text, which is lowered once and searched until the first hit."""

    def over(low: Column) -> Column:
        out = None
        for name, found in KEYWORDS:
            hit = reduce(Column.__or__, [F.contains(low, F.lit(k)) for k in found])
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out.otherwise(NO_KEYWORD)

    return let(F.lower(text), over)


def by_rules(name: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first pattern that the lower-cased name matches."""
    low = F.lower(name)
    return F.coalesce(*(F.when(low.rlike(p), F.lit(label)) for p, label in rules), F.lit(default))


def sane(value: Column, fallback: Column) -> Column:
    return F.when(value.isNull() | F.upper(F.trim(value)).isin(BANNED_VALUES), fallback).otherwise(F.trim(value))


def mapped(df: DataFrame, mapping: DataFrame, key: str, value: str, default: str = "__GAP__") -> DataFrame:
    """df with a value looked up in a mapping; misses get the default."""
    return df.join(mapping.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def salvage(text: Column, keys: list[str]) -> Column:
    """Values of keys in text that should be a JSON object: parsed from the first { to the last }, else found one by one."""
    body = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.struct(*(F.coalesce(F.get_json_object(body, f"$.{k}"), F.nullif(F.regexp_extract(text, rf'"{k}"\s*:\s*"([^"]*)"', 1), F.lit(""))).alias(k) for k in keys))
