"""Label post-processing and classifier evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def cap_labels(labels: Column, most: int = 2) -> Column:
    return F.slice(labels, 1, most)


def valid_labels(labels: Column, allowed: list[str], most: int = 2) -> Column:
    """Labels of the closed list, in their order, at most so many."""
    return F.slice(F.filter(labels, lambda x: x.isin(allowed)), 1, most)


def choose(scored: Column, floor: float, most: int = 2) -> Column:
    """Labels that reach the floor, best first; the best one if none does. scored: array of (score, label)."""
    best = F.reverse(F.array_sort(scored))
    good = F.slice(F.filter(best, lambda s: s.score >= floor), 1, most)
    return F.transform(F.when(F.size(good) > 0, good).otherwise(F.slice(best, 1, 1)), lambda s: s.label)


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def per_class(pairs: DataFrame) -> DataFrame:
    """label, tp, fp, fn, precision, recall, f1 of rows with arrays truth and predicted."""
    each = pairs.select("truth", "predicted", F.explode(F.array_union("truth", "predicted")).alias("label"))
    t, p = F.array_contains("truth", F.col("label")), F.array_contains("predicted", F.col("label"))
    counted = each.groupBy("label").agg(F.count_if(t & p).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(t & ~p).alias("fn"))
    f1 = 2.0 * F.col("tp") / F.greatest(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(1))
    counted = counted.withColumns({"_p": F.col("tp") + F.col("fp"), "_r": F.col("tp") + F.col("fn")})
    return counted.select("label", "tp", "fp", "fn", F.round(_ratio("tp", "_p"), 6).alias("precision"), F.round(_ratio("tp", "_r"), 6).alias("recall"), F.round(f1, 6).alias("f1"))


def summary(pairs: DataFrame) -> DataFrame:
    """micro_f1, macro_f1, zero_classes and exact: one row."""
    classes = per_class(pairs)
    micro = 2.0 * F.sum("tp") / F.greatest(2 * F.sum("tp") + F.sum("fp") + F.sum("fn"), F.lit(1))
    exact = pairs.agg(F.round(F.avg((F.array_sort("truth") == F.array_sort("predicted")).cast("double")), 6).alias("exact"))
    return classes.agg(F.round(micro, 6).alias("micro_f1"), F.round(F.avg("f1"), 6).alias("macro_f1"), F.count_if(F.col("f1") == 0).alias("zero_classes")).crossJoin(exact)


def sweep(scores: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold, kept, precision, recall of rows with score and truth (0 or 1)."""
    grid = scores.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    hit = F.col("score") >= F.col("threshold")
    counted = grid.groupBy("threshold").agg(F.count_if(hit).alias("kept"), F.count_if(hit & (F.col("truth") == 1)).alias("tp"), F.sum("truth").alias("positives"))
    return counted.select("threshold", "kept", F.round(_ratio("tp", "kept"), 6).alias("precision"), F.round(_ratio("tp", "positives"), 6).alias("recall"))


def confusion(pairs: DataFrame, k: int) -> DataFrame:
    """The k most frequent pairs of unequal truth and predicted."""
    return pairs.where("truth <> predicted").groupBy("truth", "predicted").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "truth", "predicted").limit(k)


def risk_coverage(rows: DataFrame, order: list[str], wrong: str, parts: int = 10) -> DataFrame:
    """tenth, n, risk: the mean of ``wrong`` in parts of equal size, in order.

    Rows are sorted by ranges, so that no task holds them all; what a range's first
    row is preceded by comes from the ranges' sizes.
    """
    # a rank within each range, plus the sizes of the ranges before
    edges = rows.stat.approxQuantile(order[0], [i / 32 for i in range(1, 32)], 0.01)
    place = F.size(F.filter(F.array(*(F.lit(float(e)) for e in sorted(set(edges)))), lambda e: e < F.col(order[0]))) if edges else F.lit(0)
    ranged = rows.withColumn("_range", place)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)))  # at most 32 rows
    total = F.sum("_n").over(W.partitionBy())
    before = before.select("_range", F.coalesce("_before", F.lit(0)).alias("_before"), total.alias("_total"))
    ranked = ranged.withColumn("_rank", F.row_number().over(W.partitionBy("_range").orderBy(*order))).join(before, "_range")
    at = (F.col("_before") + F.col("_rank") - 1) / F.greatest(F.col("_total") - 1, F.lit(1))
    return ranked.withColumn("_at", at).where("_at < 1").groupBy(F.floor(F.col("_at") * parts).cast("int").alias("tenth")).agg(F.count("*").alias("n"), F.round(F.avg(wrong), 6).alias("risk"))
