"""Label records against a closed taxonomy: validation, consistency rules, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of an embedded exchange, and markers of rendered turns.
USER_MARK, USER_LABEL, USER_PIPE = r"\[USER\]:", r"(?i)\b(?:User|Human)\s*:", r"(?i)<\|\s*(?:user|human)\s*\|>"
ANSWER_LABEL, ANSWER_PIPE = r"(?i)\b(?:Assistant|AI)\s*:", r"(?i)<\|\s*(?:assistant|ai)\s*\|>"


def validated(df: DataFrame, lists: dict[str, tuple[list[str], int | None]], scalars: dict[str, list[str]]) -> DataFrame:
    """df with labels outside the closed lists dropped, capped lists cut, and what was dropped.

    lists: column to (allowed values, most labels or None); scalars: column to allowed values.
    """
    dropped = []
    changes = {}
    for name, (allowed, most) in lists.items():
        good = _allowed(name, allowed)
        kept = F.slice(good, 1, most) if most else good
        changes[name] = kept
        dropped.append(F.transform(F.array_except(F.col(name), kept), _labelled(name)))
    for name, allowed in scalars.items():
        ok = F.col(name).isin(allowed)
        changes[name] = F.when(ok, F.col(name))
        dropped.append(F.when(F.col(name).isNotNull() & ~ok, F.array(F.concat(F.lit(f"{name}="), F.col(name)))).otherwise(F.array().cast("array<string>")))
    return df.withColumn("dropped", F.flatten(F.array(*dropped))).withColumns(changes)


def _allowed(name: str, allowed: list[str]) -> Column:
    return F.filter(name, lambda x: x.isin(allowed))


def _labelled(name: str):
    return lambda x: F.concat(F.lit(f"{name}="), x)


def embedded_history(text: Column) -> Column:
    """Whether a text holds an exchange of its own: two user marks and an answer mark."""
    many = lambda p, n: F.regexp_count(text, F.lit(p)) >= n
    return (many(USER_LABEL, 2) & many(ANSWER_LABEL, 1)) | (many(USER_PIPE, 2) & many(ANSWER_PIPE, 1))


def interaction_mode(mode: Column, text: Column) -> Column:
    """The mode after counting the turns that the text really has."""
    turns = F.regexp_count(text, F.lit(USER_MARK))
    return F.when((mode == "single_turn") & (turns >= 2), "multi_turn").when((mode == "multi_turn") & (turns <= 1) & ~embedded_history(text), "single_turn").otherwise(mode)


def tool_requirement(requirement: Column, categories: Column, mode: Column) -> Column:
    """No tool named may go with the requirement none."""
    named = F.size(categories) > 0
    return F.when(named & (requirement == "none"), F.when(mode == "agentic_loop", "required").otherwise("optional")).otherwise(requirement)


def coverage(df: DataFrame, raw: str, mapping: DataFrame, category: str, volume: str) -> DataFrame:
    """Values and volume of each category of the mapping, with those it does not cover."""
    joined = df.join(mapping.select(raw, category), raw, "left").withColumn(category, F.coalesce(category, F.lit("__GAP__")))
    return joined.groupBy(category).agg(F.countDistinct(raw).alias("n_values"), F.sum(volume).alias("volume"))


def canonical(value: Column, names: dict[str, str]) -> Column:
    """The canonical spelling of a value; others stay."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(F.trim(value))), value)
