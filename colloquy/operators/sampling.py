"""Deterministic samples: hash order stands in for a seeded shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shuffled(key: str, seed: str = "") -> Column:
    """A reproducible order that does not depend on how rows are dealt."""
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def per_group(df: DataFrame, group: str, key: str, quota: int, seed: str = "") -> DataFrame:
    """A random sample of at most ``quota`` rows of each group."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(shuffled(key, seed), key))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= quota).drop("_rank")


def round_robin(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """n rows, one of each group in turn."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(shuffled(key), key))
    return df.withColumn("_rank", rank).orderBy("_rank", group).limit(n).drop("_rank")


def systematic(df: DataFrame, group: str, order: str, step: int) -> DataFrame:
    """Every step-th row of each group."""
    at = F.row_number().over(W.partitionBy(group).orderBy(order)) - 1
    return df.withColumn("_at", at).where(F.col("_at") % step == 0).drop("_at")


def split(df: DataFrame, key: str, share: float) -> DataFrame:
    """Adds is_validation for a share of the rows, by hash: no sort of the whole table."""
    bucket = F.conv(F.substring(shuffled(key), 1, 4), 16, 10).cast("int")
    return df.withColumn("is_validation", bucket < F.lit(int(share * 65536)))


def oversampled(df: DataFrame, label: str, target: int = 400, most: int = 25) -> DataFrame:
    """Rows of rare labels repeated, at most ``most`` times, towards ``target`` rows of each label."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    times = F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(F.lit(target) / F.col("_n")))).cast("int")
    return df.join(F.broadcast(counts), label).withColumn("copy", F.explode(F.sequence(F.lit(1), times))).drop("_n")


def ends(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first and last n rows of each group."""
    first = F.row_number().over(W.partitionBy(group).orderBy(order))
    last = F.row_number().over(W.partitionBy(group).orderBy(F.desc(order)))
    return df.withColumns({"_a": first, "_b": last}).where((F.col("_a") <= n) | (F.col("_b") <= n)).drop("_a", "_b")
