"""A corpus pipeline: stages that each read the documents the stage before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crewlens.llm import stages
from crewlens.llm.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", stages.reject_low_quality),
    ("exact dedup", stages.drop_exact_copies),
    ("n-gram Jaccard join", stages.drop_near_copies),
    ("mixing sources to target weights", stages.mix_sources),
    ("BPE encoding and decoding", stages.encode),
]

#: SQL cannot express the classifier, the join's links or the tokenizer; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
