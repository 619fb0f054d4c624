"""The training corpus pipeline: toxicity, near copies, benchmark leaks, mixing, shards.

``run`` applies the stages one after the other; each result is written as Parquet in the shared
folder and read again, so that a stage starts from stored rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsvar.llm import stages
from obsvar.session import scratch_path

STAGES = [
    ("toxicity", stages.toxicity),
    ("ngram_jaccard_join", stages.near_copies),
    ("benchmark_decontamination", stages.decontamination),
    ("mixing", stages.mixing),
    ("sharding", stages.sharding),
]
#: Votes of nearest labelled examples have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
