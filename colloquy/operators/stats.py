"""Grouped statistics, totals, pivots, histograms and percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bucket(c: Column, edges: list[int], prefix: str = "") -> Column:
    """Name of the closed range that holds c; the last range is open."""
    out, low = None, 0
    for edge in edges:
        name = F.lit(f"{prefix}{low}-{edge}")
        out = F.when(c <= edge, name) if out is None else out.when(c <= edge, name)
        low = edge + 1
    return out.otherwise(F.lit(f"{prefix}>{edges[-1]}"))


def with_total(df: DataFrame, key: str, aggregates: list[Column], total: str = "TOTAL") -> DataFrame:
    """Aggregates of each key, and of all rows."""
    rolled = df.rollup(key).agg(*aggregates, F.grouping(key).alias("_g"))
    return rolled.withColumn(key, F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(key))).drop("_g")


def share(df: DataFrame, value: str, digits: int = 4, within: list[str] | None = None) -> Column:
    """Percentage of the column's sum over groups (few rows: after an aggregation)."""
    return F.round(100.0 * F.col(value) / F.sum(value).over(W.partitionBy(*(within or [F.lit(1)]))), digits)


def top_and_others(df: DataFrame, key: str, k: int, others: str = "(all others)") -> DataFrame:
    """The k most frequent keys and one row for the rest."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    top = counted.orderBy(F.desc("n"), key).limit(k)
    rest = counted.join(F.broadcast(top.select(key)), key, "left_anti").agg(F.sum("n").alias("n")).where("n is not null").select(F.lit(others).alias(key), "n")
    return top.select(key, "n").unionByName(rest)


def percentiles(df: DataFrame, group: str, value: str, points: dict[str, float]) -> DataFrame:
    """Discrete percentiles of each group: the value at place int(q * (n - 1))."""
    kind = dict(df.dtypes)[value]  # percentile_disc gives doubles
    picked = [F.expr(f"percentile_disc({q}) within group (order by {value})").cast(kind).alias(name) for name, q in points.items()]
    return df.groupBy(group).agg(*picked, F.max(value).alias("largest"))


def hierarchy(df: DataFrame, levels: list[str]) -> DataFrame:
    """Counts at every level of a hierarchy; deeper levels are null above theirs."""
    sets = [levels[: i + 1] for i in range(len(levels))]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *levels).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))
