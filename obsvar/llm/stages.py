"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsvar.llm import decontaminate, jaccard, shards
from obsvar.llm import mixing as mixes
from obsvar.llm import toxicity as toxic
from obsvar.llm.ranges import fresh


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches one half go; all given labels are learned from."""
    return toxic.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five words, 0.8) the document with the smallest id stays.

    Rows that share an id stay or go together; rows without an id stay.
    """
    groups = jaccard.similar_groups(docs, words=5, percent=80)
    name = fresh("_gone", docs)
    gone = groups.filter("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixes.repeated(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in 16 shards of nearly equal bytes."""
    placed = docs.select("doc_id", "lang", "source", "n_chars", shards.text_size().alias("size"), shards.text_crc().alias("text_crc32"))
    return shards.balanced_shards(placed, "size", [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
