"""Lookups, flags, upserts and reconciliation between tables.

Sides are broadcast by Spark where their size allows; no hint forces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flagged(df: DataFrame, key: str, lists: dict[str, DataFrame]) -> DataFrame:
    """df with ok and reason: which of the named lists of keys hold the row's key."""
    for name, keys in lists.items():
        df = df.join(keys.select(key).distinct().withColumn(f"_{name}", F.lit(name)), key, "left")
    reason = F.concat_ws(";", *(f"_{n}" for n in lists))
    return df.withColumn("reason", reason).withColumn("ok", F.col("reason") == "").drop(*(f"_{n}" for n in lists))


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """df with the value of its key; misses get the default."""
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def unseen(df: DataFrame, seen: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key an existing table does not have, the first of each key."""
    fresh = df.join(seen.select(key).distinct(), key, "left_anti")
    first = fresh.groupBy(key).agg(F.min(order).alias(order))
    return fresh.join(first.select(order), order, "left_semi")


def upsert(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """base with the rows of changes in place of those with their key, and added where there are none."""
    return base.join(changes.select(key), key, "left_anti").unionByName(changes.select(*base.columns))


def reconciled(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """key, left, right and state: missing on a side, different, or equal."""
    both = left.select(key, F.col(value).alias("left")).join(right.select(key, F.col(value).alias("right")), key, "full")
    state = F.when(F.col("left").isNull(), "no_left").when(F.col("right").isNull(), "no_right").when(F.col("left") == F.col("right"), "equal").otherwise("different")
    return both.withColumn("state", state)


def aligned(tables: dict[str, DataFrame], keys: list[str], value: str) -> DataFrame:
    """One column for each named table's value of the keys; 0 where it has none."""
    out = None
    for name, df in tables.items():
        part = df.select(*keys, F.col(value).alias(name))
        out = part if out is None else out.join(part, keys, "full")
    return out.na.fill(0, list(tables))


def phrases_in(df: DataFrame, text: str, phrases: DataFrame) -> DataFrame:
    """Rows with every phrase (phrase, label) that their lower-cased text contains.

    The phrases, a list kept by hand, are gathered into one row, so that the texts
    are scanned once without a nested-loop join.
    """
    few = phrases.agg(F.collect_list(F.struct("phrase", "label")).alias("_all"))
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    hits = df.crossJoin(F.broadcast(few)).withColumn("hit", F.explode(F.filter("_all", lambda p: F.contains(low, p.phrase))))
    return hits.withColumns({"phrase": F.col("hit.phrase"), "label": F.col("hit.label")}).drop("_all", "hit")


def relabelled(df: DataFrame, mapping: DataFrame, value: str, count: str) -> DataFrame:
    """Counts re-aggregated through one step of a mapping (value, target); values it omits stay."""
    mapped = df.join(mapping.select(value, "target"), value, "left")
    return mapped.groupBy(F.coalesce("target", value).alias(value)).agg(F.sum(count).alias(count))


def clustered(df: DataFrame, step, value: str, count: str, target: int, rounds: int = 6) -> DataFrame:
    """Mapping rounds until at most target values are left or a round merges nothing.

    step(values): a mapping (value, target) of the current values, say from a labeller.
    """
    left = df.count()
    for _ in range(rounds):
        if left <= target:
            break
        df = relabelled(df, step(df), value, count)
        now = df.count()
        if now >= left:
            break
        left = now
    return df


def changed(before: Column, after: Column) -> Column:
    """How many rows a re-run of rules changed."""
    return F.count_if(~before.eqNullSafe(after))
