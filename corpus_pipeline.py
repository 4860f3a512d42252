"""A corpus pipeline of five training-data operators.

    run(spark, sf_dir)

applies STAGES to the documents table: quality rules, language ID, SimHash
near-duplicates, benchmark decontamination, best-fit packing.  A stage takes
``(spark, docs, sf_dir)``; its result is written as Parquet below the session's
checkpoint folder and read again as the next stage's ``docs``, so a lost
executor costs one stage at most; a stage's table goes when the next is written.  The filtering stages return the columns of
documents; the last returns the pieces of packed sequences with their token ids
(``packing.sequences`` puts them together).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.llm import decontaminate, language_id, packing, quality_rules, simhash_dedup
from campaignlake.session import drop_path, scratch_path

SEQUENCE_TOKENS = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much by it or fail the base limits."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; the labelled ones train the classifier."""
    return language_id.keep_identified(docs, language_id.fit(docs.where(F.col("lang").isNotNull())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash_dedup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences; each piece comes with its token ids, so the texts are in the result."""
    return packing.pack(docs, capacity=SEQUENCE_TOKENS, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", pack),
]

# Trained models, hash functions and a tokenizer can't be told in SQL; a test holds the pipeline
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, from the documents of ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
