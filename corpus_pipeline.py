"""From raw documents to a training mixture in five stages, each on all that the one before it kept.

1. language: documents whose language can't be told go.
2. exact: of equal texts the one with the largest doc_id stays.
3. near: of each group of near-duplicates (five-word shingles, similarity 0.8) the one with the smallest doc_id stays.
4. benchmark: documents that contain a benchmark item go.
5. mixture: every source's documents are repeated or sampled towards its target; the documents that are taken, whole, and
   behind their columns how often (repetitions) and how many words that makes (taken).

Between the stages run() writes Parquet to the shared folder that spark.checkpoint.dir names and reads it again, so that
a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from papyrix.llm import decontaminate, exact_dedup, language_id, mixture, near_dedup
from papyrix.llm.common import table
from papyrix.session import for_long_texts, scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    for_long_texts(spark)
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    for_long_texts(spark)
    return near_dedup.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mixed_rows(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("benchmark", benchmark), ("mixture", mixed)]

#: Learned languages and MinHash components aren't expressible; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
