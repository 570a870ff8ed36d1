"""The corpus pipeline: five stages over documents, each one operator of the llm subpackage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes
as Parquet and reads again for the next stage. All but the last return the columns
of documents.

1. quality_filter      documents predicted to be of low quality go
2. near_duplicates     of each component of near copies (five words, 0.8) one row stays,
                       the longest text (ties: smallest doc_id, then greatest source and lang)
3. repeated_passages   bytes covered by a REPEAT_BYTES string that starts anywhere
                       else go, in all places; rows stay, n_chars follows the text
4. decontamination     documents that hold a benchmark passage, edited or not, go
5. byte_bpe            token counts and digests of each remaining document

Defined cases are those of the operators. Rows are told apart by a key of their own,
so rows with a null or repeated doc_id are documents like any other: of repeated rows
one stays, and rows without words, which are near copies of nothing, all stay. Where
repeated_passages cuts inside a character, the stray bytes go too. Empty tables pass
through empty; without labels no document reaches the quality threshold.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import quality
from colloquy.llm.bpe_replay import encode_documents
from colloquy.llm.decontaminate import clean
from colloquy.llm.ngram_jaccard import jaccard_components
from colloquy.llm.repeated_text import cut_repeats
from colloquy.llm.staging import Stages, table

#: About 50 tokens, the usual length of exact substring removal.
REPEAT_BYTES = 200
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    voter = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, voter, keep=True).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stages = Stages(spark)
    keyed = stages.keep(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "keyed")
    found = stages.keep(jaccard_components(keyed.select(F.col("row").alias("doc_id"), "text"), k=5, percent=80), "found")
    sizes = keyed.select(F.col("row").alias("doc_id"), F.struct(F.octet_length("text"), F.col("doc_id").isNotNull(), F.bitwise_not("doc_id"), "source", "lang", F.xxhash64("text"), -F.col("row")).alias("order"))
    several = found.groupBy("component_id").count().where("count > 1").select(F.col("component_id").alias("doc_id"))
    # only components of several rows are compared; each of their rows but the best goes
    inside = found.where("component_id <> doc_id").unionByName(found.join(several, "doc_id", "left_semi"))
    best = inside.join(sizes, "doc_id").groupBy("component_id").agg(F.max_by("doc_id", "order").alias("row"))
    kept = found.where("component_id = doc_id").join(several, "doc_id", "left_anti").select(F.col("doc_id").alias("row")).unionByName(best.select("row"))
    return keyed.join(kept, "row", "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = cut_repeats(docs, length=REPEAT_BYTES, with_text=True)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: No stage but the last can be expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    stages = Stages(spark)
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
