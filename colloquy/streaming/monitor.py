"""Streams: counts by source against targets, first-seen rows, and event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def counts_by(df: DataFrame, key: str) -> DataFrame:
    """Running counts of each key, for a stream or a table."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def progress(counts: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """key, n, target and percentage done, for keys of either side."""
    both = counts.join(targets, key, "full").select(key, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("target", F.lit(0)).alias("target"))
    return both.withColumn("pct", F.round(100.0 * F.col("n") / F.greatest("target", F.lit(1)), 2))


def first_seen(df: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Rows whose key was not seen within the watermark."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def tumbling(df: DataFrame, time: str, width: str, keys: list[str], late: str | None = None) -> DataFrame:
    """Counts and sums of value in windows of event time. An addition to the reference operators."""
    df = df.withWatermark(time, late) if late else df
    out = df.groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n", "total")


def sessions(df: DataFrame, time: str, gap: str, key: str, late: str | None = None) -> DataFrame:
    """Sessions of a key, ended by a gap. An addition to the reference operators."""
    df = df.withWatermark(time, late) if late else df
    out = df.groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("session_window.start").alias("session_start"), "n")


def resume(df: DataFrame, path: str, checkpoint: str):
    """Write everything that is new since the checkpoint, then stop."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
