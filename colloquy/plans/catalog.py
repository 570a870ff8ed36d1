"""All queries over the reference operators, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import cases, conversations, documents, relational, toolcalls  # noqa: F401  each registers its queries
from .registry import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["filter_report"](spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
