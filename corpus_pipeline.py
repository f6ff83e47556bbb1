"""Training-data pipeline: five stages over ``documents``, each written as Parquet and reread.

1. toxicity: documents that the classifier calls toxic go.
2. simhash: one document of each near-duplicate group (five words, similarity 0.8) stays.
3. decontaminate: documents that hold a benchmark item go.
4. mixing: rows are repeated so that domain tokens reach the target weights; a rate is at least 1, nothing clean goes.
5. token_ids: what is left, as token-id files; a row for each document.

Null texts are empty; an empty table passes through; columns beyond those of documents pass through to stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import common, decontaminate, mixing, simhash, tokens
from tickloom.llm import toxicity as toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic.accepted(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, docs, sf_dir, floor=1.0)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.digest(docs)


STAGES = [("toxicity", toxicity), ("simhash", near_duplicates), ("decontaminate", decontamination), ("mixing", mix), ("token_ids", token_ids)]
#: No stage but the mixing could be written in SQL: models, hashes and a tokenizer. tests/llm has brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.stored(stage(common.prepare(spark), docs, sf_dir), f"stage-{name}", "snappy")
    return docs
