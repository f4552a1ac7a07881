"""The corpus pipeline: language ID, near-dedup, decontamination, mixing and sharding of ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm import stages
from ticketloom.runtime import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", stages.identify_language),
    ("near_duplicates", stages.drop_near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("mixing", stages.mix_sources),
    ("sharding", stages.shard),
]

#: SQL can't learn the language model or sign multisets; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what one keeps is written before the next one starts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
