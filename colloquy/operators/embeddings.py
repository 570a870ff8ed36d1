"""Centroid classification of embeddings and relatedness of pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """label and the mean vector of its rows: one row for each class."""
    each = vectors.select(label, F.posexplode(vector).alias("pos", "x")).groupBy(label, "pos").agg(F.avg("x").alias("x"))
    packed = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return each.groupBy(label).agg(F.transform(packed, lambda p: p.x).alias("centroid"))


def nearest_centroids(vectors: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """vec_id, rank, label, cosine of the k nearest classes; classes are few and broadcast."""
    few = classes.select(F.col("label").alias("class"), "centroid").agg(F.collect_list(F.struct("class", "centroid")).alias("all"))
    scored = vectors.crossJoin(F.broadcast(few)).select(
        "vec_id", "label", F.transform("all", lambda c: F.struct(F.round(cosine(F.col("embedding"), c.centroid), 6).alias("cosine"), (-c["class"]).alias("negative"))).alias("s")
    )
    best = scored.select("vec_id", "label", F.slice(F.reverse(F.array_sort("s")), 1, k).alias("s"))
    return best.select("vec_id", F.col("label").alias("truth"), F.posexplode("s").alias("rank", "x")).select("vec_id", "truth", (F.col("rank") + 1).alias("rank"), (-F.col("x.negative")).alias("label"), "x.cosine")


def relatedness(pairs: DataFrame, control: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Pairs (id, cosine) below a quantile of the control's cosines."""
    bound = control.agg(F.expr(f"percentile_disc({quantile}) within group (order by cosine)").alias("bound"))
    return pairs.crossJoin(F.broadcast(bound)).where("cosine < bound")


def ranked(df: DataFrame, group: str, score: str, tie: str, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(F.desc(score), tie))).where(F.col("rank") <= k)
