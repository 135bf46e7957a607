"""From raw documents to packed sequences: quality rules, toxicity, near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewell.llm import jaccard, mixing, packing, rules, toxicity
from ratewell.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality), ("toxicity", not_toxic), ("n-gram Jaccard join", unique), ("mixing sources", mixed), ("packing", packed)]
# Learned models, MinHash and the linear program are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
    return docs
