"""Exact duplicates, caps by key, provenance, and loops of phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import collapse, let, ngrams, top_grams, words


def text_key(c: Column) -> Column:
    """Identity of a text up to case and white space."""
    return F.md5(F.lower(collapse(F.coalesce(c, F.lit("")))))


def first_wins(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Of the rows with an equal key, the first in order.

    A partial aggregation finds the first of each key, so that a key with very many
    rows is no hot task; order must be unique.
    """
    keyed = df.withColumn("_key", key)
    first = keyed.groupBy("_key").agg(F.min(order).alias(order))
    return keyed.join(first.select(order), order, "left_semi").drop("_key")


def cap_by_key(df: DataFrame, keys: list, order: list, cap: int) -> DataFrame:
    """At most ``cap`` rows of each key, in order. The limit is pushed below the exchange."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= cap).drop("_rank")


def provenance(df: DataFrame, key: Column, order: str, place: str) -> DataFrame:
    """place, first_place and how many rows of place repeat a row whose first is in first_place."""
    keyed = df.select(F.col(order), F.col(place), key.alias("_key"))
    first = keyed.groupBy("_key").agg(F.min(F.struct(order, place)).alias("f")).select("_key", F.col(f"f.{order}").alias("first"), F.col(f"f.{place}").alias("first_place"))
    return keyed.join(first, "_key").where(F.col(order) != F.col("first")).groupBy(place, "first_place").agg(F.count("*").alias("n"))


def top_phrases(df: DataFrame, key: str, text: str, n: int, k: int) -> DataFrame:
    """key, gram, times, rank: each text's k most frequent n-grams of words; ties: first seen."""
    grams = df.select(key, F.posexplode(ngrams(words(F.col(text)), n)).alias("pos", "gram"))
    counted = grams.groupBy(key, "gram").agg(F.count("*").alias("times"), F.min("pos").alias("pos"))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc("times"), "pos"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= k).select(key, "gram", "times", "rank")


def looped(c: Column, words_least: int = 150, times: int = 12, lettered: int = 5) -> Column:
    """How often the most frequent ten words occur where they are a loop, else null. Counted within the row."""

    def over(w: Column) -> Column:
        top = F.get(F.filter(top_grams(w, 10, 1), lambda g: (g.times >= times) & (F.size(F.filter(g.gram, lambda x: x.rlike(r"\p{L}"))) >= lettered)), F.lit(0))
        return F.when(F.size(w) >= words_least, top.times)

    return let(words(c), over)


def phrase_loops(df: DataFrame, key: str, text: str, words_least: int = 150, times: int = 12, lettered: int = 5) -> DataFrame:
    """key and times of texts whose most frequent ten-word phrase is a loop."""
    return df.select(key, looped(F.col(text), words_least, times, lettered).cast("long").alias("times")).where("times is not null")


def repeated_prompts(chats: DataFrame, prompt: Column, answer: Column, least: int, different: int = 3) -> DataFrame:
    """Prompts that at least ``least`` chats share, with several different answer beginnings."""
    rows = chats.select(text_key(prompt).alias("prompt_key"), F.left(F.coalesce(answer, F.lit("")), F.lit(60)).alias("head"))
    return rows.groupBy("prompt_key").agg(F.count("*").alias("n"), F.countDistinct("head").alias("n_answers")).where((F.col("n") >= least) & (F.col("n_answers") >= different))


def longest_per_key(df: DataFrame, key: Column, size: Column, order: str) -> DataFrame:
    """Of the rows with an equal key the longest one; ties: the first."""
    keyed = df.withColumn("_key", key)
    best = keyed.groupBy("_key").agg(F.max_by(order, F.struct(size, -F.col(order))).alias(order))
    return keyed.join(best.select(order), order, "left_semi").drop("_key")
