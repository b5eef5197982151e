"""A training corpus from raw documents, one operator of ``cohortkit.llm`` per stage.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's documents.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.decontaminate import decontaminate
from cohortkit.llm.ngram_join import keep_one
from cohortkit.llm.quality import keep_good
from cohortkit.llm.queries import bpe_digests
from cohortkit.llm.substring_dedup import substring_dedup
from cohortkit.llm.tables import write_table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies."""
    return keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences of passages that stand elsewhere before;
    ``n_chars`` follows the text.  A document that loses its every word goes."""
    return substring_dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left, from encoding and decoding it."""
    return bpe_digests(docs)


STAGES = [
    ("quality", good_documents),
    ("ngram_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("decontaminate", without_benchmark),
    ("bpe", token_digests),
]

#: A classifier is trained in the first stage: SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = write_table(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
