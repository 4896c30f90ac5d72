"""Corpus pipeline: quality → exact dedup → near-dedup → decontamination → mixing.

Each stage takes (spark, docs, sf_dir), and its result is written as Parquet to the shared folder and
read back as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listinglake.llm import common, decontaminate, exact_dedup, mixing, quality, simhash_dedup


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(docs, k=4, d=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [("quality classifier", good), ("exact dedup", exact), ("simhash near-dedup", near),
          ("benchmark decontamination", benchmark), ("mixing to target weights", mix)]

# the classifier and the fingerprints cannot be written in SQL: tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.stored(docs, f"stage-{i + 1}")
    return docs
