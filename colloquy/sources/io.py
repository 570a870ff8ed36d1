"""Sources and sinks: JSON lines, CSV, Parquet, kept and rejected rows, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None, pattern: str = "*.jsonl*") -> DataFrame:
    """Rows of all JSON lines files below path, gzip included; lines that do not parse are null rows with their text in _bad."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    return (reader.schema(f"{schema}, _bad string") if schema else reader).json(path)


def read_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl*") -> DataFrame:
    """value (the line, unchanged) and file."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def write_kept_and_rejected(df: DataFrame, reasons: Column, kept: str, rejected: str, compression: str = "gzip") -> None:
    """Rows without reasons to one folder of JSON lines, the others with their reasons to another."""
    tagged = df.withColumn("reasons", reasons)
    tagged.where(F.size("reasons") == 0).drop("reasons").write.mode("overwrite").option("compression", compression).json(kept)
    row = F.to_json(F.struct(*df.columns)).alias("row")
    tagged.where(F.size("reasons") > 0).select("reasons", row).write.mode("overwrite").option("compression", compression).json(rejected)


def write_partitioned(df: DataFrame, key: str, path: str, files_per_key: int = 8) -> None:
    """One folder for each value of key. Rows of a frequent value are spread over several files."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_key))
    df.repartition(F.col(key), salt).write.mode("overwrite").partitionBy(key).parquet(path)


def stringify_nested(df: DataFrame) -> DataFrame:
    """Nested columns become JSON strings."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")}
    return df.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """column and type of the files at path, from footers only."""
    return spark.createDataFrame(spark.read.parquet(path).dtypes, "column string, type string")


def markdown(df: DataFrame, most: int = 10_000) -> str:
    """A small result as a Markdown table."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report")
    out = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(out + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows])
